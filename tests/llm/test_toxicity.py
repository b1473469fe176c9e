import random
import zlib

import pytest
from fareweave.llm import toxicity as T


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def nearest(word, terms):
    best = None
    for n, t in enumerate(terms):
        heads = [word] if t.whole else [word[:i] for i in range(len(word) + 1)]
        d = min(distance(h, t.text) for h in heads)
        if d <= T.edits_allowed(len(t.text)) and (best is None or (d, n) < best):
            best = (d, n)
    return best


def test_automaton_is_the_edit_distance():
    rng = random.Random(2)
    terms = [T.Term("idiot", True), T.Term("lowei", False), T.Term("abc", True), T.Term("worthless", True), T.Term("pathet", False)]
    lexicon = T.Lexicon(terms)
    words = []
    for _ in range(3000):
        base = list(rng.choice(["idiot", "lowei", "abc", "worthless", "pathetic", "loweischaft", "other"]))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(base))
            base[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "i", "o", "e"])
        words.append("".join(base))
    for w in words:
        assert lexicon.match(w) == nearest(w, terms), w


def test_quotation_and_abuse():
    lexicon = T.Lexicon([T.Term("idiot", True)])
    hits, _ = T.find_hits('He wrote that. "What an idi0t" was the line. Later on and far from that line you are an IDIOT!', lexicon)
    assert [(h.edits, h.quoted, h.addressed) for h in hits] == [(1, True, False), (0, False, True)]
    text = "so İ say, an idiot"
    hit = T.find_hits(text, lexicon)[0][0]
    assert text[hit.begin : hit.end] == "idiot"


def corpus(n=1500, seed=4):
    rng = random.Random(seed)
    plain = ["".join(rng.choices(["ba", "lo", "mi", "ren", "tu", "vas"], k=rng.randint(2, 4))) for _ in range(400)]
    bad, rows, labels = ["grunk", "sloffer", "plorken"], [], []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(10, 80))
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(3):
                w = rng.choice(bad)
                if rng.random() < 0.2:
                    at = rng.randrange(1, len(w))
                    w = w[:at] + "0" + w[at + 1 :]
                words.insert(rng.randrange(len(words)), w if w != "plorken" else w + rng.choice(plain))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_rows(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 as score", "1 as id")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = T.train(docs, known)
    assert {t.text for t in model.lexicon.terms} >= {"grunk", "sloffer", "plorken"}
    got = T.score(docs, model).withColumn("held", T.held_out(T.F.col("doc_id"))).collect()
    truth = dict(labels)
    held = [r for r in got if r.held]
    assert {r.doc_id for r in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum((r.score >= 0.3) == truth[r.doc_id] for r in held) / len(held) > 0.98
    spans = next(r for r in got if r.hits)
    assert dict(rows)[spans.doc_id][spans.hits[0].begin : spans.hits[0].end]
    # Labels of held-out rows change nothing.
    other = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels]
    again = T.train(docs, spark.createDataFrame(other, "doc_id long, toxic int"))
    assert again.lexicon.terms == model.lexicon.terms and again.weights == pytest.approx(model.weights)
    kept = T.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.score < 0.3}


def test_edges(spark):
    rows, labels = corpus(300)
    docs = spark.createDataFrame([*rows, (None, None), (9000, ""), (9001, "grunk " * 50_000), (9001, "x")], "doc_id long, text string")
    known = spark.createDataFrame([*labels, (None, 1), (1, None), (77_777, 1), *labels[:20]], "doc_id long, toxic int")
    model = T.train(docs, known)
    got = T.score(docs, model).collect()
    assert len(got) == 304 and all(0 <= r.score <= 1 for r in got)
    assert max(r.score for r in got if r.doc_id == 9001) > 0.9
    empty = known.limit(0)
    none = T.train(docs, empty)
    assert all(r.score < 1e-9 for r in T.score(docs, none).collect())
    clean = T.train(docs, known.where("toxic = 0"))
    assert all(r.score < 0.1 for r in T.score(docs, clean).collect())
    assert T.score(docs.limit(0), model).count() == 0 and T.train(docs.limit(0), known).lexicon.terms == []


def test_training_rows_are_bounded(spark):
    rows, labels = corpus(1200)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    some = T.training_rows(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), max_rows=100)
    assert 50 < some.count() < 160


def test_rare_terms_are_learnt_from_all_labelled_rows(spark):
    rows, labels = corpus(4000, seed=8)
    rare = [i for i, y in labels if y and zlib.crc32(str(i).encode()) % 4 != 2][:12]
    rows = [(i, "quiet words and zumbrak here") if i == rare[0] else (i, t + " zumbrak" if i in rare else t) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = T.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), max_rows=400)
    # In under 2 % of the toxic texts, and in about one text of the sample.
    assert "zumbrak" in {t.text for t in model.lexicon.terms}
    assert len(model.lexicon.terms) < 12
