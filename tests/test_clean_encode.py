"""Cleaning, encoding and scaling on the literal micro-tables and on edge cases."""

import math

import pytest

from pyspark.sql import functions as F

from fareweave.operators.clean import Imputer, drop_columns, fit_imputer, handle_missing_values, null_counts
from fareweave.operators.encode import (
    TooManyCategories,
    fit_one_hot,
    fit_scaler,
    ordinal_from_one_hot,
    severity_from_one_hot,
)
from fareweave.config import ID_COLUMNS


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_nothing_missing_changes_nothing(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "a long, b string")
    out = handle_missing_values(df)
    assert out.dtypes == df.dtypes and rows(out) == rows(df)
    assert fit_imputer(df).gaps == ()


def test_median_fills_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (4.0,), (5.0,), (float("nan"),)], "a double")
    assert sorted(r[0] for r in handle_missing_values(df).collect()) == [1.0, 3.0, 3.5, 3.5, 4.0, 5.0]


def test_integer_column_widens_for_a_fractional_median(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    out = handle_missing_values(df)
    assert dict(out.dtypes)["a"] == "double"
    assert sorted(r[0] for r in out.collect()) == [1.0, 1.5, 2.0]


def test_mode_takes_the_smallest_of_equals(spark):
    df = spark.createDataFrame([("x",), ("y",), ("x",), (None,), ("y",)], "a string")
    assert sorted(r[0] for r in handle_missing_values(df).collect()) == ["x", "x", "x", "y", "y"]


def test_all_missing_columns_are_left_and_reported(spark):
    df = spark.createDataFrame([(None, None, 1.0), (None, None, 2.0)], "a double, b string, c double")
    imputer = fit_imputer(df)
    assert set(imputer.empty) == {"a", "b"}
    assert rows(imputer.transform(df)) == rows(df)


def test_empty_table(spark):
    df = spark.createDataFrame([], "a double, b string")
    assert fit_imputer(df) == Imputer(empty=("a", "b"))
    assert {r["row_count"] for r in null_counts(df).collect()} == {0}


def test_fit_and_apply_are_separate(spark):
    train = spark.createDataFrame([(1.0,), (3.0,), (None,)], "a double")
    other = spark.createDataFrame([(None,), (100.0,)], "a double")
    assert sorted(r[0] for r in fit_imputer(train).transform(other).collect()) == [2.0, 100.0]


def test_gaps_that_turn_up_later_are_filled(spark):
    train = spark.createDataFrame([(1, True, "a", 1.0), (2, True, "a", 2.0), (4, False, "b", 4.0)], "i int, b boolean, s string, d double")
    later = spark.createDataFrame([(None, None, None, None), (9, False, "c", float("nan"))], train.schema)
    out = fit_imputer(train).transform(later)
    assert out.schema["i"].dataType == train.schema["i"].dataType
    assert rows(out) == [(2, True, "a", 2.0), (9, False, "c", 2.0)]


def test_booleans_take_their_mode(spark):
    df = spark.createDataFrame([(True,), (False,), (False,), (None,)], "b boolean")
    assert sorted(r[0] for r in handle_missing_values(df).collect()) == [False, False, False, True]


def test_drop_columns(spark):
    df = spark.createDataFrame([(1, 10, 5)], "ride_id long, value long, other long")
    assert drop_columns(df, ID_COLUMNS).columns == ["value", "other"]


def test_one_hot(spark):
    df = spark.createDataFrame([("clear", 1.0), ("rain", 2.0), ("clear", 3.0), ("snow", 4.0)], "weather string, v double")
    out = fit_one_hot(df, ["weather"], 20).transform(df)
    assert out.columns == ["v", "weather_clear", "weather_rain", "weather_snow"]
    assert rows(out) == [(1.0, 1.0, 0.0, 0.0), (2.0, 0.0, 1.0, 0.0), (3.0, 1.0, 0.0, 0.0), (4.0, 0.0, 0.0, 1.0)]


def test_one_hot_unknown_and_null_give_zeros(spark):
    fit = spark.createDataFrame([("clear",), ("rain",), (None,)], "weather string")
    new = spark.createDataFrame([("clear",), ("snow",), (None,)], "weather string")
    out = fit_one_hot(fit, ["weather"], 20).transform(new)
    assert out.columns == ["weather_clear", "weather_rain"]
    assert rows(out) == [(0.0, 0.0), (0.0, 0.0), (1.0, 0.0)]


def test_too_many_categories_is_an_error(spark):
    df = spark.range(20).selectExpr("cast(id as string) as c")
    with pytest.raises(TooManyCategories):
        fit_one_hot(df, ["c"], max_categories=10)
    assert len(fit_one_hot(df, ["c"], max_categories=20).names()) == 20


def test_ordinal_from_one_hot(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 0.0), (0.0, 0.0)], "weather_condition_storm double, weather_condition_snow double")
    twice = severity_from_one_hot(severity_from_one_hot(df))
    assert [r["weather_severity_score"] for r in twice.collect()] == [4, 3, 0]
    assert ordinal_from_one_hot(df, "absent", {"a": 1}, "s").columns == df.columns


def test_scaler_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 6)], "a double")
    scaler = fit_scaler(df, ["a"])
    assert scaler.means["a"] == 3.0 and scaler.stds["a"] == pytest.approx(math.sqrt(2))
    out = [r[0] for r in scaler.transform(df).collect()]
    assert abs(sum(out)) < 1e-10
    assert sum(v * v for v in out) / 5 == pytest.approx(1.0)


def test_scaler_applies_stored_state(spark):
    scaler = fit_scaler(spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "a double"), ["a"])
    out = [r[0] for r in scaler.transform(spark.createDataFrame([(10.0,), (20.0,)], "a double")).collect()]
    assert sum(out) / 2 > 1.0


def test_scaler_edge_columns(spark):
    df = spark.createDataFrame(
        [(7.0, None, 1.0), (7.0, None, float("nan")), (7.0, None, 3.0)], "same double, none double, gap double"
    )
    scaler = fit_scaler(df, ["same", "none", "gap"])
    out = scaler.transform(df).collect()
    assert {r["same"] for r in out} == {0.0}
    assert {r["none"] for r in out} == {None}
    assert scaler.means["gap"] == 2.0


def test_state_is_fitted_from_two_scans(spark, rides):
    """One scan counts all values, one adds up the engineered features."""
    from fareweave.plans.prepare import fit_state

    seen = spark.sparkContext.accumulator(0)

    def passed(x):
        seen.add(1)
        return x

    size = rides.count()
    raw = rides.withColumn("hour_of_day", F.udf(passed, "int")("hour_of_day"))
    assert fit_state(raw) == fit_state(rides)
    assert seen.value == 2 * size


def test_state_from_counts_of_gappy_rides(spark, rides):
    """The same as medians, modes and categories found one by one."""
    from fareweave.operators.clean import column_modes
    from fareweave.operators.quantiles import exact_quantiles
    from fareweave.plans.prepare import BASE_FEATURES, fit_state

    i = F.col("ride_id")
    gappy = rides.withColumns(
        {
            "temperature": F.when(i % 5 == 0, None).when(i % 7 == 0, float("nan")).otherwise(F.col("temperature")),
            "passenger_demand": F.when(i % 3 != 0, F.col("passenger_demand")),
            "weather_condition": F.when(i % 4 != 0, F.col("weather_condition")),
            "is_weekend": F.when(i % 6 != 0, F.col("is_weekend")),
        }
    )
    state = fit_state(gappy)
    numeric = [c for c in BASE_FEATURES if c != "is_weekend"]
    assert state.imputer.medians == {c: q[0] for c, q in exact_quantiles(gappy, numeric, [0.5]).items()}
    modes = column_modes(gappy, ["weather_condition", "is_weekend"])
    assert state.imputer.modes == {"weather_condition": modes["weather_condition"], "is_weekend": modes["is_weekend"] == "true"}
    assert state.imputer.gaps == ("passenger_demand", "temperature") and state.imputer.empty == ()
    assert state.encoder == fit_one_hot(gappy, ["weather_condition"], 10)
