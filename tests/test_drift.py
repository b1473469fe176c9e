"""Drift statistics against NumPy and closed forms, and their properties."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareweave.functions.pvalues import chi_square_tail, kolmogorov_tail, normal_two_sided
from fareweave.operators import drift as D
from fareweave.operators.whatif import CONTROL, DEMAND_SPIKES, Scenario, apply_scenario, apply_scenarios, demand_spike
from fareweave.plans import monitoring as M

LARGE = D.DriftOptions(route="large")


def frame(spark, **columns):
    names = list(columns)
    data = [tuple(None if v is None else v for v in row) for row in zip(*columns.values())]
    kinds = {n: "string" if any(isinstance(v, str) for v in columns[n]) else "double" for n in names}
    return spark.createDataFrame(data, ", ".join(f"{n} {kinds[n]}" for n in names))


def floats(values):
    return [float(v) for v in values]


def w1(a, b):
    xs = np.unique(np.concatenate([a, b]))
    f = np.searchsorted(np.sort(a), xs, side="right") / len(a)
    g = np.searchsorted(np.sort(b), xs, side="right") / len(b)
    return np.sum(np.abs(f - g)[:-1] * np.diff(xs)), np.max(np.abs(f - g))


def report(spark, a, b, options=LARGE, **kw):
    out = D.drift_report(a, b, options=options, **kw)
    return {r["feature"]: r for r in out.collect()}


@pytest.mark.parametrize("parts", [None, 7, 200])
def test_wasserstein_matches_numpy(spark, parts):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=900), rng.normal(0.3, 1.4, size=700)
    a[:300] = 0.25
    options = D.DriftOptions(route="large", parts=parts)
    row = report(spark, frame(spark, x=floats(a)), frame(spark, x=floats(b)), options)["x"]
    assert row["test"] == "wasserstein"
    assert row["score"] == pytest.approx(w1(a, b)[0] / a.std(), rel=1e-9)
    small = D.DriftOptions(route="small", parts=parts)
    row = report(spark, frame(spark, x=floats(a)), frame(spark, x=floats(b)), small)["x"]
    assert row["statistic"] == pytest.approx(w1(a, b)[1], rel=1e-9)


def test_identical_tables_do_not_drift(spark):
    a = frame(spark, x=floats(range(100)), c=["u", "v"] * 50)
    rows = report(spark, a, a)
    assert rows["x"]["score"] == 0.0 and rows["c"]["score"] == 0.0
    assert not any(r["drift_detected"] for r in rows.values())


def test_pure_shift(spark):
    x = np.random.default_rng(2).normal(size=400)
    row = report(spark, frame(spark, x=floats(x)), frame(spark, x=floats(x + 2.5)))["x"]
    assert row["score"] * x.std() == pytest.approx(2.5, rel=1e-9)


def test_disjoint_categories_reach_the_bound(spark):
    row = report(spark, frame(spark, c=["a", "b"]), frame(spark, c=["x", "y"]))["c"]
    assert row["test"] == "jensen_shannon" and row["score"] == pytest.approx(math.sqrt(math.log(2)))
    row = report(spark, frame(spark, x=[0.0, 0.0]), frame(spark, x=[1.0, 1.0]))["x"]
    assert row["test"] == "jensen_shannon" and row["score"] == pytest.approx(math.sqrt(math.log(2)))


def test_constant_reference_uses_the_floor(spark):
    a = frame(spark, x=[1.0] * 10)
    b = frame(spark, x=floats(range(10)))
    expected = w1(np.ones(10), np.arange(10.0))[0] / 0.001
    assert report(spark, a, b)["x"]["score"] == pytest.approx(expected)


def test_missing_values_are_skipped(spark):
    a = frame(spark, x=[float(i) for i in range(20)] + [None, float("nan"), float("inf")], y=[None] * 23)
    b = frame(spark, x=[float(i) for i in range(20)], y=[None] * 20)
    rows = report(spark, a, b)
    assert rows["x"]["score"] == 0.0 and rows["x"]["reference_rows"] == 23
    assert rows["y"]["test"] is None and rows["y"]["drift_detected"] is False


def test_empty_current(spark):
    a = frame(spark, x=floats(range(20)), c=["a", "b"] * 10)
    rows = report(spark, a, a.limit(0))
    assert all(r["score"] is None and not r["drift_detected"] for r in rows.values())
    assert rows["x"]["current_rows"] == 0


def test_partitions_do_not_matter(spark, rides):
    a, b = rides.where("ride_id % 2 = 0"), rides.where("ride_id % 2 = 1")
    skip = ["ride_id", "timestamp"]

    def scores(parts):
        columns = D.drift_columns(a, b, skip)
        return {f: r["score"] for f, r in report(spark, a.repartition(parts), b.repartition(parts), columns=columns).items()}

    one, many = scores(1), scores(8)
    assert one.keys() == many.keys() and "is_weekend" in one
    for feature, score in one.items():
        assert score == pytest.approx(many[feature], abs=1e-9)


def test_small_branch_tests_and_p_values(spark):
    a = frame(spark, k=floats(range(50)), c=["a", "b", "c", "a", "b"] * 10, z=[0.0, 1.0] * 25)
    b = frame(spark, k=floats(range(20, 70)), c=["a"] * 25 + ["b"] * 15 + ["c"] * 10, z=[0.0] * 40 + [1.0] * 10)
    rows = report(spark, a, b, D.DriftOptions(route="small"))
    assert {f: r["test"] for f, r in rows.items()} == {"k": "ks", "c": "chi_square", "z": "z"}
    assert rows["k"]["statistic"] == pytest.approx(0.4)
    assert rows["k"]["score"] == pytest.approx(kolmogorov_tail(5 * 0.4)) and rows["k"]["drift_detected"]
    assert rows["c"]["statistic"] == pytest.approx(25 / 20 + 25 / 20)
    assert rows["c"]["score"] == pytest.approx(math.exp(-1.25)) and not rows["c"]["drift_detected"]
    z = (0.5 - 0.2) / math.sqrt(0.35 * 0.65 * (2 / 50))
    assert abs(rows["z"]["statistic"]) == pytest.approx(z)
    assert rows["z"]["score"] == pytest.approx(normal_two_sided(z)) and rows["z"]["drift_detected"]


def test_unseen_category_has_p_zero(spark):
    a = frame(spark, c=["a", "b", "c"] * 10)
    b = frame(spark, c=["a", "b", "d"] * 10)
    row = report(spark, a, b, D.DriftOptions(route="small"))["c"]
    assert row["score"] == 0.0 and row["drift_detected"]


def test_p_value_helpers():
    assert normal_two_sided(1.959963984540054) == pytest.approx(0.05)
    for x, df, p in [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (7.814727903251179, 3, 0.05), (18.307038053275146, 10, 0.05)]:
        assert chi_square_tail(x, df) == pytest.approx(p)
    assert kolmogorov_tail(1.3580986393225505) == pytest.approx(0.05, abs=1e-6)
    # Many degrees of freedom take no longer, and the cube root takes over smoothly.
    assert chi_square_tail(1e6, 10**6) == pytest.approx(0.5, abs=1e-3)
    assert chi_square_tail(1e13, 10**13) == pytest.approx(0.5, abs=1e-3)
    assert chi_square_tail(5.0, 10**9) == pytest.approx(1.0)


def test_the_caller_chooses_the_route(spark):
    big = spark.range(1001).selectExpr("cast(id % 6 as double) as six", "cast(id % 5 as double) as five")
    for table in (big, big.limit(1000), big.limit(30)):
        rows = report(spark, table, big, D.DriftOptions())
        assert (rows["six"]["test"], rows["five"]["test"]) == ("wasserstein", "jensen_shannon")
        rows = report(spark, table, big, D.DriftOptions(route="small"))
        assert (rows["six"]["test"], rows["five"]["test"]) == ("ks", "chi_square")
    with pytest.raises(ValueError):
        report(spark, big, big, D.DriftOptions(route="auto"))


def test_summary_order_and_policies(spark):
    a = frame(spark, b=floats(range(100)), a=floats(range(100)), c=floats(range(100)))
    cur = a.select((F.col("b") + 50).alias("b"), (F.col("a") + 50).alias("a"), "c")
    scores = D.drift_report(a, cur, options=LARGE)
    row = D.summarize(scores, LARGE).first()
    assert row["drifted_features"] == ["b", "a"] and row["n_drifted_features"] == 2 and row["dataset_drift"]
    assert row["drift_scores"]["c"]["drift_detected"] is False
    assert not D.summarize(scores, D.DriftOptions(policy="min_features")).first()["dataset_drift"]
    assert D.summarize(scores, D.DriftOptions(policy="share")).first()["dataset_drift"]
    with pytest.raises(ValueError):
        D.summarize(scores, D.DriftOptions(policy="none"))


def test_scores_grow_with_severity(spark, rides):
    out = M.compare_scenarios(rides, options=LARGE).collect()
    score = {(r["scenario"], r["feature"]): r["score"] for r in out}
    for feature in ("passenger_demand", "temperature", "demand_supply_ratio"):
        mild, moderate, severe = (score[(f"demand_{s}", feature)] for s in ("mild", "moderate", "severe"))
        assert 0 < mild < moderate < severe
    assert all(score[("control", f)] == 0.0 for f in M.drift_features())
    graded = score[("weather_storm", "weather_condition_storm")]
    assert 0 < graded < math.sqrt(math.log(2))


def test_scenarios_together_equal_one_by_one(spark, rides):
    every = apply_scenarios(rides, [CONTROL, *DEMAND_SPIKES.values()])
    for s in [CONTROL, *DEMAND_SPIKES.values()]:
        alone = apply_scenario(rides, s)
        part = every.where(F.col("scenario") == s.name).select(*alone.columns)
        assert alone.exceptAll(part).count() == 0 and part.exceptAll(alone).count() == 0


def test_scenario_without_some_columns(spark):
    df = spark.createDataFrame([(10, 4, 8, 5.0)], "passenger_demand int, driver_availability int, hour_of_day int, base_fare double")
    row = apply_scenario(df, demand_spike("severe")).first()
    assert (row["passenger_demand"], row["driver_availability"]) == (40, 1)
    assert row["demand_supply_ratio"] == 20.0
    assert "temperature" not in row.asDict() and "demand_weather_interaction" not in row.asDict()


def test_sampled_simulation(spark, rides):
    samples = {"control": (200, 42), "demand_mild": (300, 42), "weather_storm": (150, 99)}
    scenarios = [CONTROL, DEMAND_SPIKES["mild"], Scenario("weather_storm", weather="storm")]
    out = M.run_simulation(rides, scenarios, LARGE, samples).collect()
    assert {r["scenario"]: r["current_rows"] for r in out} == {"control": 200, "demand_mild": 300, "weather_storm": 150}
    assert {r["reference_rows"] for r in out} == {1000}


def test_bad_scenarios_do_not_stop_the_rest(spark, rides):
    out = {r["scenario"]: r for r in M.run_simulation(rides, ["mild", "worst", Scenario("neg", demand_factor=-1.0)], LARGE).collect()}
    assert out["demand_mild"]["error"] is None and out["demand_mild"]["dataset_drift"]
    assert "worst" in out["worst"]["error"] and out["neg"]["error"]
    only_bad = M.run_simulation(rides, ["worst"], LARGE)
    assert only_bad.count() == 1


def test_detector_and_history(spark, rides, tmp_path):
    from fareweave.sources.files import read_drift_history

    detector = M.DriftDetector(rides, LARGE)
    with pytest.raises(ValueError):
        detector.scores()
    detector.set_current_data(rides.withColumn("temperature", F.col("temperature") + 30))
    path = str(tmp_path / "history")
    for when in ("2024-02-01 10:00:00", "2024-02-02 10:00:00"):
        row = detector.generate_report(when, path).first()
    assert row["drifted_features"] == ["temperature"]
    history = read_drift_history(spark, path)
    assert history.count() == 2 and history.select("run_date").distinct().count() == 2
    assert "price_multiplier" in {r["feature"] for r in M.DriftDetector(rides, LARGE, include_target=True).set_current_data(rides).scores().collect()}
