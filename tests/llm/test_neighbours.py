import numpy as np
import pytest
from fareweave.llm import neighbours as N
from fareweave.llm.queries import QUERIES
from pyspark.sql import functions as F


def brute(ids, vectors, most=20, step=20):
    """For each query, (id, score) of the best rows by a plain scan."""
    x = np.asarray(vectors, dtype=float)
    out = {}
    for i in [i for i, v in enumerate(ids) if v % step == 0]:
        scores = (x * x[i]).sum(axis=1)
        best = sorted((-s, v) for s, v in zip(scores, ids) if v != ids[i])[:most]
        out[ids[i]] = [(v, -s) for s, v in best]
    return out


def by_query(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for entries in found.values():
        assert [rank for rank, _, _ in entries] == list(range(1, len(entries) + 1))
        assert [(-s, v) for _, v, s in entries] == sorted((-s, v) for _, v, s in entries)
    return {q: [(v, s) for _, v, s in entries] for q, entries in found.items()}


def recall(got, truth):
    hits = sum(len({v for v, _ in truth[q]} & {v for v, _ in got.get(q, [])}) for q in truth)
    return hits / sum(len(t) for t in truth.values())


def test_transform_is_orthogonal():
    x = np.random.default_rng(0).normal(size=(5, 16))
    y = N.hadamard(x)
    assert np.allclose(N.hadamard(y), x) and np.allclose((y**2).sum(axis=1), (x**2).sum(axis=1))


@pytest.mark.parametrize(("rows", "width"), [(100, 1), (1000, 3), (60_000, 64), (10_000_000, 64), (10**9, 50)])
def test_codes_and_penalties(rows, width):
    index = N.Index.of(rows, width, 4 * width, 2, 1)
    buckets = np.prod([2 * a for a in index.axes])
    assert rows / N.BUCKET_ROWS / 4 <= buckets <= max(2, rows / N.BUCKET_ROWS)
    unit = N.unit_rows(np.random.default_rng(1).normal(size=(50, width)))
    for t in range(2):
        codes, costs = index.codes(unit, t), index.penalties(unit, t)
        for h, cost in enumerate(costs):
            assert (cost >= 0).all() and (cost[np.arange(50), codes[:, h]] == 0).all()
        # The bound of a unit holds for every row in it.
        least = index.least_by_unit(unit, t)
        group = index.prefix(codes) % index.units
        total = sum(c[:, codes[:, h]] for h, c in enumerate(costs))
        assert (least[:, group] <= total + 1e-12).all()


@pytest.mark.parametrize("name", ["sf0.01", "sf0.1"])
def test_recall_on_the_given_tables(spark, name):
    folder = f"/root/testdata/{name}"
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    truth = brute([r.vec_id for r in vectors], [r.embedding for r in vectors])
    got = by_query(QUERIES["op11_neighbours"](spark, folder).collect())
    assert got.keys() == truth.keys() and all(len(v) == 20 for v in got.values())
    assert recall(got, truth) >= 0.93
    scores = {(q, v): s for q, found in truth.items() for v, s in found}
    assert all(abs(scores[q, v] - s) < 1e-14 for q, found in got.items() for v, s in found if (q, v) in scores)


def clustered(n=6000, width=24, seed=3):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(40, width))
    which = np.where(random.random(n) < 0.35, 0, random.integers(0, 40, n))  # one cluster holds a third
    x = centres[which] + 0.15 * random.normal(size=(n, width))
    x *= np.exp(random.normal(size=(n, 1)))  # lengths differ widely
    x[random.integers(0, n, 800)] = x[5]  # a group of copies
    return x


def test_clusters_copies_and_cut_units(spark, monkeypatch):
    x = clustered()
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    truth = brute(list(range(len(x))), x)
    whole = by_query(N.nearest(table, F.col("vec_id") % 20 == 0).collect())
    assert recall(whole, truth) >= 0.93
    monkeypatch.setattr(N, "UNIT_BYTES", 24 * 8 * 100)
    index = N.Index.of(len(x), 24, 24 * 8, 2, 42)
    packed = N._packed(table.selectExpr("vec_id as id", "embedding", "false as is_query"), "embedding", "<f8")
    assert max(N._cuts(packed, index, "<f8", 24 * 8).values()) > 1
    cut = by_query(N.nearest(table.repartition(9), F.col("vec_id") % 20 == 0).collect())
    assert recall(cut, truth) >= 0.93


def test_a_radius_around_all_neighbours_gives_them_all(spark):
    x = clustered(1500, 8)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = by_query(N.nearest(table, F.col("vec_id") % 20 == 0, most=7, wanted_recall=1.0).collect())
    assert got == brute(list(range(len(x))), x, most=7)


def test_odd_rows(spark):
    good = [(i, [float(i % 7), 1.0, -0.5 * i]) for i in range(45)]
    bad = [
        (60, None), (80, [0.0, 0.0, 0.0]), (100, [1.0, None, 2.0]), (120, [float("nan"), 1.0, 1.0]), (140, [float("inf"), 1.0, 1.0]),
        (160, []), (None, [1.0, 2.0, 3.0]), (200, [1.0, 2.0]),
    ]
    table = spark.createDataFrame(good + bad + [good[3], good[40], good[40]], "vec_id long, embedding array<float>")
    table = table.selectExpr("*", "1 as id", "2 as unit", "3 as kind", "4 as score", "5 as query_id", "'x' as rank", "6 as vector")
    got = by_query(N.nearest(table, F.col("vec_id") % 20 == 0, wanted_recall=1.0).collect())
    assert got == brute(list(range(45)), np.array([v for _, v in good], dtype=np.float32))


def test_few_rows(spark):
    schema = "vec_id long, embedding array<double>"
    query = F.col("vec_id") % 20 == 0
    assert N.nearest(spark.createDataFrame([], schema), query).collect() == []
    assert N.nearest(spark.createDataFrame([(0, [1.0])], schema), query).collect() == []
    assert N.nearest(spark.createDataFrame([(1, [1.0]), (2, [2.0])], schema), query).collect() == []
    rows = N.nearest(spark.createDataFrame([(0, [1.0, 0.0]), (3, [0.0, 2.0]), (2, [0.0, 2.0]), (7, [-1.0, 0.0])], schema), query, wanted_recall=1.0)
    assert [(r["rank"], r.vec_id, r.score) for r in rows.orderBy("rank").collect()] == [(1, 2, 0.0), (2, 3, 0.0), (3, 7, -1.0)]
    types = dict(rows.dtypes)
    assert types == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}


def test_runs_agree(spark):
    folder = "/root/testdata/sf0.01"
    a, b = (sorted(map(tuple, QUERIES["op11_neighbours"](spark, folder).collect())) for _ in range(2))
    assert a == b
