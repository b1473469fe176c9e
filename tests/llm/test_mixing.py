import random

import pytest
from fareweave.llm import mixing as M

SCHEMA = "doc_id long, text string, source string"


def corpus(n=900, sources=7, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = f"s{rng.randrange(sources)}" if rng.random() < 0.6 else "s0"
        rows.append((i, " ".join(["w"] * rng.choice([1, 3, 20, 50, 200])), None if rng.random() < 0.05 else source))
    return rows


def filled(sizes, weights, share=1.5, most=2.0):
    """Targets by dealing out the excess again and again."""
    left, got = share * sum(sizes.values()), dict.fromkeys(sizes, 0.0)
    open_ = {s for s in sizes if weights[s] > 0 and sizes[s] > 0}
    while left > 1e-9 and open_:
        unit = left / sum(weights[s] for s in open_)
        left = 0.0
        for s in list(open_):
            got[s] += unit * weights[s]
            if got[s] >= most * sizes[s]:
                left += got[s] - most * sizes[s]
                got[s] = most * sizes[s]
                open_.discard(s)
    return got


def test_targets_and_samples(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    rows = M.mix_sizes(docs, M.cycled_weights(docs)).collect()
    source = {i: s for i, _, s in corpus()}
    sizes, taken, targets, largest = {}, {}, {}, {}
    for r in rows:
        s = source[r.doc_id]
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        targets[s] = r.target
        largest[s] = max(largest.get(s, 0), r.size)
        assert r.taken in (0, r.size, 2 * r.size) and r.taken == r.copies * r.size
    order = sorted(sizes, key=lambda s: (s is None, s))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    expected = filled(sizes, weights)
    assert len(rows) == 900
    for s in sizes:
        assert targets[s] == pytest.approx(expected[s])
        assert abs(taken[s] - targets[s]) <= max(5, 0.02 * targets[s])
    again = M.mix_sizes(docs.repartition(5), M.cycled_weights(docs)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in rows)


def test_inclusion_follows_the_chance(spark):
    docs = spark.createDataFrame([(i, "w", "a") for i in range(4000)] + [(i, "w w", "b") for i in range(4000, 6000)], SCHEMA)
    rows = M.mix_sizes(docs, spark.createDataFrame([("a", 1.0), ("b", 3.0)], "source string, weight double"), share=0.8)
    got = rows.selectExpr("doc_id < 4000 AS a", "taken", "target").groupBy("a").agg({"taken": "sum", "target": "max"}).collect()
    assert {r["a"]: (r["sum(taken)"], r["max(target)"]) for r in got} == {True: (1600, 1600.0), False: (4800, 4800.0)}


def test_documents_of_a_mix(spark, tmp_path):
    rows = corpus(300, 4, 2)
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 as id", "2 as key", "3 as row", "4 as size", "5 as copies", "6 as chance", "7 as cut"
    ).write.parquet(path)
    docs = spark.read.parquet(path)
    mixed = M.mix_documents(docs, M.cycled_weights(docs))
    assert mixed.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    plan = {r.doc_id: r.copies for r in M.mix_sizes(docs, M.cycled_weights(docs)).collect()}
    assert counts == {i: c for i, c in plan.items() if c}
    texts = {i: t for i, t, _ in rows}
    assert all(texts[r.doc_id] == r.text for r in mixed.collect())


def test_edges(spark):
    rows = [(1, None, "a"), (1, "x y", "a"), (1, "x y", "a"), (None, "z z z", None), (2, "", "b"), (3, "q " * 90_000, "c")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = M.mix_sizes(docs, M.cycled_weights(docs)).collect()
    assert len(got) == 6 and all(r.taken <= 2 * r.size for r in got)
    assert sorted(r.size for r in got) == [0, 0, 2, 2, 3, 90_000]
    empty = docs.limit(0)
    assert M.mix_sizes(empty, M.cycled_weights(empty)).count() == 0
    assert M.mix_documents(empty, M.cycled_weights(empty)).count() == 0
    unweighed = M.mix_sizes(docs, spark.createDataFrame([("a", None), ("b", 2.0)], "source string, weight double")).collect()
    assert sum(r.taken for r in unweighed) == 0
    repeated = spark.createDataFrame([(7, "w w", "a")] * 500 + [(8, "w", "b")] * 100, SCHEMA)
    got = M.mix_sizes(repeated, M.cycled_weights(repeated)).collect()
    for doc_id in (7, 8):
        own = [r for r in got if r.doc_id == doc_id]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2
