import hashlib
from collections import defaultdict

import numpy as np
from fareweave.llm import exact_dedup as X
from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=60, unique=True))
def test_messages_come_back(numbers):
    numbers = np.array(sorted(numbers), dtype=np.uint64)
    assert (X.rice_decode(X.rice_encode(numbers)) == numbers).all()


def test_messages_are_short():
    numbers = np.unique(np.random.default_rng(0).integers(0, 2**40, 10_000, dtype=np.uint64))
    assert len(X.rice_encode(numbers)) < 10_000 * (27 + 3) / 8


def brute(rows):
    groups = defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        groups[text or ""].append((doc_id is not None, doc_id or 0, i))
    out = []
    for text, members in groups.items():
        keep = max(members)
        keep_id = keep[1] if keep[0] else None
        for there, doc_id, _ in members:
            digest = hashlib.sha256(text.encode()).hexdigest()
            out.append((doc_id if there else None, keep_id, len(members), digest))
    return sorted(out, key=str)


ROWS = [
    (1, "a b"), (2, "a b"), (3, "a  b"), (4, None), (5, ""), (6, "x" * 300_000), (7, "x" * 300_000),
    (8, "x" * 299_999), (None, "a b"), (None, "only"), (9, "é"), (9, "é"), (9, "é"), (10, "é"), (None, "n"), (None, "n"),
]


def test_against_brute_force(spark):
    docs = spark.createDataFrame(ROWS * 3, "doc_id long, text string").repartition(7)
    docs = docs.selectExpr("*", "1 as print", "'x' as sha", "0 as row", "0 as part", "true as kept")
    got = X.exact_duplicates(docs).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == brute(ROWS * 3)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_all_bytes_are_compared_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(X, "BROADCAST_PRINTS", 0)
    got = X.exact_duplicates(spark.createDataFrame(ROWS, "doc_id long, text string")).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == brute(ROWS)


def test_hash_partners_with_other_texts_are_no_copies(spark):
    """A fingerprint alone never makes a copy: the texts of suspects are grouped by their bytes."""
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(500)], "doc_id long, text string")
    assert X.exact_duplicates(docs).where("kept AND group_size = 1 AND keep_id = doc_id").count() == 500


def test_rows_that_stay(spark):
    docs = spark.createDataFrame(ROWS * 2, "doc_id long, text string").selectExpr(
        "*", "'s' as source", "1 as _text_sha256", "2 as _id", "3 as _sha"
    )
    kept = X.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == len({t or "" for _, t in ROWS})
    best = {}
    for doc_id, text in ROWS:
        best[text or ""] = max(best.get(text or "", -1), -1 if doc_id is None else doc_id)
    assert {(r.text or ""): -1 if r.doc_id is None else r.doc_id for r in rows} == best


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert X.exact_duplicates(docs).count() == 0 and X.drop_exact_duplicates(docs).count() == 0
