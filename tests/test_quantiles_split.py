"""Exact quantiles against NumPy, and splits and samples against brute force."""

import hashlib
import math

import numpy as np
import pytest

from fareweave.functions.numeric import hash_hex
from fareweave.operators import split as S
from fareweave.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def check(spark, columns, parts):
    names = list(columns)
    data = list(zip(*[[None if v is None else float(v) for v in columns[c]] for c in names]))
    df = spark.createDataFrame(data, ", ".join(f"{n} double" for n in names)).repartition(7)
    got = exact_quantiles(df, names, PROBS, parts)
    for n in names:
        values = [v for v in columns[n] if v is not None and not math.isnan(v)]
        if not values:
            assert got[n] == [None] * len(PROBS)
        else:
            np.testing.assert_allclose(got[n], np.quantile(values, PROBS), rtol=1e-12)


@pytest.mark.parametrize("parts", [None, 60])
def test_quantiles_match_numpy(spark, parts):
    rng = np.random.default_rng(5)
    n = 4000
    hot = np.where(rng.random(n) < 0.4, 1.0, np.where(rng.random(n) < 0.6, 2.0, rng.normal(size=n)))
    gaps = [None if i % 5 == 0 else (float("nan") if i % 7 == 0 else float(i % 97)) for i in range(n)]
    check(
        spark,
        {
            "normal": rng.normal(size=n),
            "hot": hot,
            "few": rng.integers(0, 3, n),
            "gaps": gaps,
            "same": np.full(n, 4.0),
            "none": [None] * n,
        },
        parts,
    )


def test_quantiles_with_infinities(spark):
    df = spark.createDataFrame([(float("inf"),), (1.0,), (2.0,), (3.0,), (float("-inf"),)], "a double")
    assert exact_quantiles(df, ["a"], [0.25, 0.5, 0.75], 1)["a"] == [1.0, 2.0, 3.0]


def digest(key, seed):
    return hashlib.md5(f"{key}|{seed}".encode()).hexdigest()


def test_exact_split_and_sample(spark):
    df = spark.range(1003).withColumnRenamed("id", "k")
    ranked = sorted(range(1003), key=lambda k: digest(k, 42))
    for parts in (1, 8):
        split = S.exact_split(df.repartition(parts), "k", 0.2, 42)
        assert {r["k"] for r in split.where("split = 'test'").collect()} == set(ranked[:201])
        sample = S.exact_sample(df.repartition(parts), "k", 50, 42)
        assert {r["k"] for r in sample.collect()} == set(ranked[:50])


def test_sample_of_everything(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    assert S.exact_sample(df, "k", 50, 1).count() == 10
    assert S.exact_split(df.limit(0), "k", 0.2, 1).count() == 0


def test_shared_and_missing_keys(spark):
    same = spark.range(100).selectExpr("cast(0 as long) as k")
    split = S.exact_split(same, "k", 0.2, 42)
    assert {r["split"]: r["count"] for r in split.groupBy("split").count().collect()} == {"test": 20, "train": 80}
    mixed = spark.range(1000).selectExpr("if(id % 10 = 0, id, null) as k", "id % 3 as v").repartition(5)
    for n in (1, 37, 500, 899, 999):
        sample = S.exact_sample(mixed, "k", n, 7)
        assert sample.count() == n
        assert sample.exceptAll(mixed).count() == 0
    test = S.exact_split(mixed, ["k", "v"], 0.33, 7)
    assert test.where("split = 'test'").count() == 330 and test.drop("split").exceptAll(mixed).count() == 0


def test_a_missing_part_keeps_its_place(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert len({r[0] for r in df.select(hash_hex(["x", "y"], 1)).collect()}) == 2


def test_hash_split_does_not_depend_on_partitions_but_on_seed(spark):
    df = spark.range(500).withColumnRenamed("id", "k")

    def tests(parts, seed):
        out = S.hash_split(df.repartition(parts), "k", 0.2, seed)
        return {r["k"] for r in out.where("split = 'test'").collect()}

    assert tests(1, 42) == tests(8, 42) != tests(8, 99)
    assert 60 < len(tests(1, 42)) < 140


def test_union_and_head(spark):
    df = S.hash_split(spark.range(50).withColumnRenamed("id", "k"), "k", 0.2, 42)
    both = S.union_splits(df.where("split = 'train'"), df.where("split = 'test'"))
    assert both.count() == 50
    assert [r["k"] for r in S.first_rows(both, "k").collect()] == [0, 1, 2, 3, 4]
