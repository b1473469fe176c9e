"""Queries with an SQL twin, and those that need another judge, on the given tables."""

import __spark_entry__ as entry
import numpy as np
import pytest
from checker import compare, connect
from fareweave.llm.oracle import ORACLES
from fareweave.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    assert compare(connect(FOLDER), ORACLES[name], QUERIES[name](spark, FOLDER)) == []


def test_every_operator_is_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert sorted({int(n[2:].split("_")[0]) for n in names if n.startswith("op")}) == list(range(1, 14))


def test_toxicity_of_rows_held_out(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op5_toxicity"](spark, folder).where("held_out").collect()
    pairs = np.array([(r.score, labels[r.doc_id], r.predicted) for r in rows if r.doc_id in labels])
    positive, negative = pairs[pairs[:, 1] == 1, 0], pairs[pairs[:, 1] == 0, 0]
    ranks = (positive[:, None] > negative).mean() + (positive[:, None] == negative).mean() / 2
    assert ranks > 0.9
    assert (pairs[pairs[:, 2] == 1, 1] == 1).mean() > 0.95


def test_simhash_of_the_given_documents(spark):
    from test_simhash import brute, plain

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    prints = [plain(r.text) for r in docs]
    expected = brute([r.doc_id for r in docs], prints, 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op8_simhash"](spark, folder).collect()}
    assert got == {r.doc_id: (f"{p:016x}", c) for r, p, c in zip(docs, prints, expected, strict=True)}


def test_vectors_of_the_given_table(spark):
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    unit = np.array([r.embedding for r in vectors], dtype=float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    counts = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in QUERIES["op9_embeddings"](spark, FOLDER).collect()}
    assert got == {r.vec_id: int(c) for r, c in zip(vectors, counts, strict=True)}
