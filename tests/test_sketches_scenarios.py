"""Mergeable sketches, exact Kolmogorov-Smirnov tails, and scenarios that fail."""

import itertools

import numpy as np
import pytest
from fareweave.functions.pvalues import exact_ks_tail, kolmogorov_tail
from fareweave.operators import drift as D
from fareweave.operators import whatif as X
from fareweave.operators.clean import fit_imputer
from fareweave.operators.sketches import K, approx_quantiles, merge_sketches, rank_error, sketch_columns, sketch_quantiles
from fareweave.plans import monitoring as M
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

SHARES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def within(values, quantiles, k=K):
    """Whether each estimate's exact rank is within twice the bound, ties included."""
    values, slack = np.sort(values), 2 * rank_error(k) * len(values) + 1
    for p, q in zip(SHARES, quantiles):
        below, upto = np.searchsorted(values, q, "left"), np.searchsorted(values, q, "right")
        assert below - slack <= p * len(values) <= upto + slack, (p, q)


@pytest.fixture(scope="module")
def table(spark):
    i = F.col("id")
    df = spark.range(0, 60_000, numPartitions=7).select(
        (i % 9).alias("part"),
        (F.rand(1) * 1000).alias("even"),
        F.when(i % 3 == 0, 5.0).otherwise(F.pow(F.rand(2), 6) * 1e6).alias("skewed"),
        F.when(i % 4 == 0, None).when(i % 4 == 1, float("nan")).otherwise(i % 11).cast("double").alias("gappy"),
        F.lit(None).cast("double").alias("empty"),
        (i % 1000).cast("int").alias("whole"),
    )
    return df.cache()


COLUMNS = ["even", "skewed", "gappy", "empty", "whole"]


@pytest.mark.parametrize("k", [64, 200, K])
def test_merged_sketches_are_within_the_bound(table, tmp_path, spark, k):
    path = str(tmp_path / "parts")
    sketch_columns(table, COLUMNS, ["part"], k).write.parquet(path)
    parts = spark.read.parquet(path)
    assert parts.count() == 9 * len(COLUMNS)
    merged = {r.feature: r for r in sketch_quantiles(merge_sketches(parts, k=k), SHARES).collect()}
    once = approx_quantiles(table, COLUMNS, SHARES, k)
    for c in COLUMNS[:3] + ["whole"]:
        values = np.array([r[0] for r in table.where(F.col(c).isNotNull() & ~F.isnan(c)).select(c).collect()], dtype=float)
        assert merged[c].n == len(values)
        within(values, merged[c].quantiles, k)
        within(values, once[c], k)
        assert merged[c].quantiles[0] == values.min() and merged[c].quantiles[-1] == values.max()
    assert merged["empty"].n == 0 and merged["empty"].quantiles is None and once["empty"] == [None] * len(SHARES)


def test_some_parts_only_and_few_values(table, spark):
    parts = sketch_columns(table, ["whole"], ["part"]).where("part < 3")
    row = sketch_quantiles(merge_sketches(parts), [0.5]).first()
    values = np.array([r[0] for r in table.where("part < 3").select("whole").collect()])
    assert row.n == len(values) and abs(np.median(values) - row.quantiles[0]) <= 2 * rank_error() * 1000 + 1
    few = spark.createDataFrame([(1.0,), (3.0,), (2.0,)], "x double")
    assert approx_quantiles(few, ["x"], [0.0, 0.5, 1.0])["x"] == [1.0, 2.0, 3.0]
    assert approx_quantiles(few.where("x > 9"), ["x"], [0.5]) == {"x": [None]}
    assert approx_quantiles(few, [], [0.5]) == {}


def test_medians_of_the_imputer(table):
    exact, near = (fit_imputer(table.drop("part"), approx=a) for a in (False, True))
    assert exact.medians.keys() == near.medians.keys() and exact.gaps == near.gaps and exact.empty == near.empty
    assert near.medians["gappy"] == pytest.approx(exact.medians["gappy"], abs=1)
    assert near.medians["even"] == pytest.approx(exact.medians["even"], abs=5)


def enumerated(x, y):
    pooled = np.array([*x, *y])

    def distance(mask):
        mask = np.array(mask)
        return max(abs((mask & (pooled <= v)).sum() / mask.sum() - (~mask & (pooled <= v)).sum() / (~mask).sum()) for v in set(pooled))

    n, size = len(x), len(pooled)
    given_ = distance([i < n for i in range(size)])
    all_ = [distance([i in chosen for i in range(size)]) for chosen in map(set, itertools.combinations(range(size), n))]
    return given_, sum(d >= given_ - 1e-12 for d in all_) / len(all_)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=5), st.lists(st.integers(0, 5), min_size=1, max_size=5))
def test_exact_tail_against_all_deals(x, y):
    distance, p = enumerated(x, y)
    ties = [int(c) for c in np.unique([*x, *y], return_counts=True)[1]]
    assert exact_ks_tail(ties, len(x), len(y), distance) == pytest.approx(p, abs=1e-12)


def test_exact_tail_of_eight_and_eight():
    x, y = [1, 2, 2, 3, 5, 8, 9, 9], [2, 4, 4, 6, 9, 9, 10, 12]
    distance, p = enumerated(x, y)
    ties = [int(c) for c in np.unique([*x, *y], return_counts=True)[1]]
    assert exact_ks_tail(ties, 8, 8, distance) == pytest.approx(p, abs=1e-12)


def test_exact_tail_nears_its_limit():
    n = 2000
    assert exact_ks_tail([1] * (2 * n), n, n, 0.05) == pytest.approx(kolmogorov_tail((n / 2) ** 0.5 * 0.05), abs=0.005)
    assert exact_ks_tail([4], 2, 2, 0.0) == 1.0 and exact_ks_tail([], 0, 3, 0.5) == 1.0


def test_exact_route_in_a_report(spark):
    x, y = [1.0, 2.0, 2.0, 3.0, 7.0, 8.0], [2.0, 9.0, 9.0, 10.0, 12.0]
    a = spark.createDataFrame([(v, v) for v in x], "x double, twin double")
    b = spark.createDataFrame([(v, None) for v in y], "x double, twin double")
    for options in (D.DriftOptions(route="small", exact_ks=True, few_values=2), D.DriftOptions(route="small", few_values=2)):
        rows = {r.feature: r for r in D.drift_report(a, b, ["x", "twin"], options).collect()}
        distance, p = enumerated(x, y)
        assert rows["x"].statistic == pytest.approx(distance) and rows["twin"].score is None
        assert (rows["x"].score == pytest.approx(p)) == options.exact_ks


BROKEN = X.Scenario("broken", changes=(("base_fare", "base_fare / (day_of_week - day_of_week)"),))


def test_a_scenario_that_fails_leaves_the_others(rides):
    options = D.DriftOptions()
    alone = {r.scenario: r for r in M.run_simulation(rides, ["severe", X.CONTROL], options).collect()}
    unknown = X.Scenario("unknown", changes=(("base_fare", "no_such_column + 1"),))
    found = {r.scenario: r for r in M.run_simulation(rides, [BROKEN, "severe", unknown, "wild", X.CONTROL], options).collect()}
    assert found.keys() == {"broken", "demand_severe", "unknown", "wild", "control"}
    assert "DIVIDE_BY_ZERO" in found["broken"].error and "UNRESOLVED_COLUMN" in found["unknown"].error
    assert "severity must be" in found["wild"].error
    for name in ("demand_severe", "control"):
        assert found[name].error is None and found[name].drifted_features == alone[name].drifted_features
        assert found[name].drift_scores == alone[name].drift_scores


def test_the_shared_scan_fails_over_to_one_job_each(rides, monkeypatch):
    shared = X.apply_scenarios

    def failing(df, scenarios):
        return shared(df, scenarios).withColumn("base_fare", F.expr("base_fare / (day_of_week - day_of_week)"))

    monkeypatch.setattr(M, "apply_scenarios", failing)
    found = {r.scenario: r for r in M.run_simulation(rides, ["mild", X.CONTROL]).collect()}
    assert all(r.error is None for r in found.values()) and found["control"].n_drifted_features == 0


def test_all_scenarios_fail(rides):
    rows = M.run_simulation(rides, [BROKEN]).collect()
    assert [(r.scenario, "DIVIDE_BY_ZERO" in r.error) for r in rows] == [("broken", True)]
    with pytest.raises(ValueError):
        X.apply_scenarios(rides, [BROKEN])
