"""Ride features, validation, metrics and scoring on literal rows."""

import math

import pytest
from pyspark.sql import functions as F

from fareweave.functions import rides as R
from fareweave.functions.numeric import clip, round_half_even, truncate
from fareweave.operators.evaluate import best_model, compare_models, evaluate, evaluate_models
from fareweave.operators.features import ENGINEERED, add_features
from fareweave.operators.quality import check_rules, ride_rules, split_requests, validate_requests, values_outside
from fareweave.operators.score import finish_prediction, formula_scorer, score_requests
from fareweave.sources.files import requests_from_rows

REQUEST = {
    "hour_of_day": 18,
    "day_of_week": 2,
    "is_weekend": False,
    "passenger_demand": 50,
    "driver_availability": 10,
    "weather_condition": "rain",
    "temperature": 12.5,
    "visibility_km": 5.0,
    "base_fare": 8.5,
}


def request(spark, **changes):
    return requests_from_rows(spark, [{**REQUEST, **changes}])


def text_request(spark, **changes):
    row = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in REQUEST.items()}
    row.update(changes)
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))


def feature(spark, name, **changes):
    return add_features(request(spark, **changes)).first()[name]


def test_all_features_are_added(spark):
    assert set(ENGINEERED) <= set(add_features(request(spark)).columns)


def test_ratio(spark):
    assert feature(spark, "demand_supply_ratio", passenger_demand=100) == pytest.approx(100 / 11)


def test_division_by_zero_gives_null(spark):
    row = add_features(request(spark, driver_availability=-1)).first()
    assert row["demand_supply_ratio"] is None and row["fare_per_driver"] is None


@pytest.mark.parametrize("hour,rush", [(6, 0), (7, 1), (9, 1), (10, 0), (14, 0), (17, 1), (18, 1), (19, 1), (20, 0), (None, 0)])
def test_rush(spark, hour, rush):
    assert feature(spark, "is_rush_hour", hour_of_day=hour) == rush


@pytest.mark.parametrize("hour,night", [(21, 0), (22, 1), (2, 1), (5, 1), (6, 0), (None, 0)])
def test_night(spark, hour, night):
    assert feature(spark, "is_night", hour_of_day=hour) == night


@pytest.mark.parametrize("weather,score", [("clear", 0), ("cloudy", 1), ("rain", 2), ("storm", 3), ("snow", 4), ("hail", 1), (None, 1)])
def test_severity(spark, weather, score):
    assert feature(spark, "weather_severity_score", weather_condition=weather) == score


def test_features_are_idempotent(spark, rides):
    once = add_features(rides)
    assert once.exceptAll(add_features(once)).count() == 0


def test_clip_round_truncate(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (-5.0,), (1.125,), (99.0,)], "a double")
    out = df.select(clip(F.col("a"), 0.0, 10.0).alias("c"), round_half_even(F.col("a"), 2).alias("r")).collect()
    assert out[0]["c"] is None and math.isnan(out[1]["c"])
    assert [r["c"] for r in out[2:]] == [0.0, 1.125, 10.0]
    assert out[3]["r"] == 1.12
    cut = spark.createDataFrame([(2.9,), (-2.9,)], "a double").select(truncate(F.col("a")).alias("t"))
    assert [r["t"] for r in cut.collect()] == [2, -2]


@pytest.mark.parametrize(
    "p,label", [(1.0, "low"), (1.29, "low"), (1.3, "medium"), (2.0, "medium"), (2.01, "high"), (2.5, "high"), (2.51, "low"), (None, None)]
)
def test_confidence(spark, p, label):
    df = spark.createDataFrame([(p,)], "p double")
    assert df.select(R.confidence(F.col("p"))).first()[0] == label


# --- validation


def errors(df):
    return validate_requests(df).first()["errors"]


def test_valid_request(spark):
    assert errors(request(spark)) == [] and errors(text_request(spark)) == []


@pytest.mark.parametrize(
    "changes,code",
    [
        ({"weather_condition": "hurricane"}, "weather_condition:range"),
        ({"hour_of_day": 25}, "hour_of_day:range"),
        ({"day_of_week": 7}, "day_of_week:range"),
        ({"base_fare": -5.0}, "base_fare:range"),
        ({"base_fare": 0.0}, "base_fare:range"),
        ({"base_fare": float("nan")}, "base_fare:range"),
        ({"visibility_km": -1.0}, "visibility_km:range"),
        ({"passenger_demand": -1}, "passenger_demand:range"),
        ({"driver_availability": None}, "driver_availability:missing"),
    ],
)
def test_invalid_requests(spark, changes, code):
    assert errors(request(spark, **changes)) == [code]


def test_text_requests(spark):
    assert errors(text_request(spark, hour_of_day="18.5")) == ["hour_of_day:type"]
    assert errors(text_request(spark, is_weekend="maybe")) == ["is_weekend:type"]
    assert errors(text_request(spark, is_weekend="on")) == []


def test_missing_columns(spark):
    found = errors(request(spark).select("hour_of_day", "base_fare"))
    assert len(found) == 7 and all(e.endswith(":missing") for e in found)


def test_quarantine_keeps_raw_values(spark):
    both = text_request(spark, hour_of_day="25").unionByName(text_request(spark))
    accepted, rejected = split_requests(both)
    assert accepted.count() == 1 and accepted.schema["hour_of_day"].dataType.simpleString() == "int"
    row = rejected.first()
    assert row["hour_of_day"] == "25" and row["errors"] == ["hour_of_day:range"]


@pytest.mark.parametrize("weather", ["clear", "cloudy", "rain", "storm", "snow"])
def test_every_weather_is_scored(spark, weather):
    scored, _ = score_requests(request(spark, weather_condition=weather), formula_scorer)
    row = scored.first()
    assert 1.0 <= row["price_multiplier"] <= 3.0
    assert row["confidence"] in ("low", "medium", "high")


def test_price_and_monotone_demand(spark):
    scored, _ = score_requests(request(spark, base_fare=10.0), formula_scorer)
    row = scored.first()
    assert abs(row["estimated_price"] - 10.0 * row["price_multiplier"]) < 0.1

    def multiplier(demand):
        return score_requests(request(spark, passenger_demand=demand), formula_scorer)[0].first()["price_multiplier"]

    assert multiplier(100) >= multiplier(5)


def test_price_comes_from_the_unrounded_multiplier(spark):
    df = spark.createDataFrame([(1.004, 100.0), (9.0, 10.0), (0.2, 10.0)], "prediction double, base_fare double")
    out = [tuple(r)[2:] for r in finish_prediction(df).collect()]
    assert out == [(1.0, 100.4, "low"), (3.0, 30.0, "low"), (1.0, 10.0, "low")]


# --- metrics


def metrics(spark, y, p):
    df = spark.createDataFrame(list(zip(y, p)), "y double, p double")
    return evaluate(df, "y", "p").first()


def test_metric_vectors(spark):
    ones = [1.0, 2.0, 3.0, 4.0, 5.0]
    perfect = metrics(spark, ones, ones)
    assert (perfect["rmse"], perfect["mae"], perfect["r2"]) == (0.0, 0.0, 1.0)
    assert metrics(spark, [1.0, 2.0, 3.0], [1.5, 2.5, 3.5])["rmse"] == pytest.approx(0.5)
    assert metrics(spark, ones, ones[::-1])["r2"] == pytest.approx(-3.0)


def test_constant_target(spark):
    assert metrics(spark, [2.0, 2.0], [2.0, 2.0])["r2"] == 1.0
    assert metrics(spark, [2.0, 2.0], [2.0, 3.0])["r2"] == 0.0


def test_comparison_order_and_ties(spark):
    df = spark.createDataFrame(
        [("train", 1.0, 1.0, 1.0, 1.5), ("test", 2.0, 2.0, 2.0, 3.0), ("test", 3.0, 3.0, 3.0, 3.5)],
        "split string, y double, b double, a double, c double",
    )
    table = compare_models(evaluate_models(df, "y", {"mb": "b", "ma": "a", "mc": "c"}))
    assert [r["model_name"] for r in table.collect()] == ["ma", "mb", "mc"]
    assert best_model(table).first()["best_model"] == "ma"


def test_rules(spark, rides):
    report = check_rules(rides, ride_rules(rides)).collect()
    assert len(report) == 10 and all(r["passed"] for r in report)
    broken = rides.withColumn("base_fare", F.lit(None).cast("double"))
    failed = {r["rule"] for r in check_rules(broken, ride_rules(broken)).collect() if not r["passed"]}
    assert failed == {"base_fare_positive", "no_missing"}
    assert values_outside(rides, "weather_condition", list(R.WEATHER_SEVERITY)).count() == 0
