"""Rides derived from an event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareweave.functions import rides as R
from fareweave.functions.numeric import clip, lookup, round_half_even
from fareweave.schema import EVENTS, RIDES
from fareweave.storage import materialize

# Event type standing for each weather category.
EVENT_WEATHER = {"view": "clear", "click": "cloudy", "signup": "rain", "error": "storm"}
OTHER_WEATHER = "snow"
DRIVER_EVENTS = ["signup", "purchase"]

HOUR = "_hour"


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")


def _hour_bucket() -> Column:
    return F.date_trunc("hour", F.col("ts"))


def hourly_supply(events: DataFrame) -> DataFrame:
    """Demand and distinct drivers per hour.

    The distinct count groups by hour and user first, so one busy hour is spread
    over its users before the per-hour counts are added up.
    """
    driver = F.when(F.col("event_type").isin(DRIVER_EVENTS), F.col("user_id"))
    return (
        events.groupBy(_hour_bucket().alias(HOUR))
        .agg(
            F.count(F.lit(1)).alias("passenger_demand"),
            F.greatest(F.lit(1).cast("long"), F.count_distinct(driver)).alias("driver_availability"),
        )
    )


def event_columns() -> dict[str, Column]:
    """Ride columns that need nothing but the event row."""
    hour = F.hour("ts")
    weekday = F.weekday("ts")
    k = F.get_json_object("props", "$.k").cast("double")
    wobble = (F.col("user_id") % 11 - 5) / F.lit(10.0)
    return {
        "ride_id": F.col("event_id"),
        "timestamp": F.col("ts"),
        "hour_of_day": hour,
        "day_of_week": weekday,
        "is_weekend": R.is_weekend(weekday),
        "weather_condition": lookup(F.col("event_type"), EVENT_WEATHER, OTHER_WEATHER),
        "temperature": k * F.lit(0.5) - F.lit(10.0),
        "visibility_km": round_half_even(clip(F.col("value"), 1.0, 200.0) / F.lit(10.0), 4),
        "base_fare": round_half_even(R.clip_fare(R.cyclic_fare(hour) + wobble), 6),
    }


def with_multiplier(rides: DataFrame) -> DataFrame:
    """Add the target: the price formula plus a fixed residual by ride id, unrounded."""
    residual = (F.col("ride_id") % 11 - 5) / F.lit(100.0)
    formula = R.formula_multiplier(
        R.demand_supply_ratio(F.col("passenger_demand"), F.col("driver_availability")),
        R.weather_severity(F.col("weather_condition")),
        R.is_rush_hour(F.col("hour_of_day")),
        F.col("is_weekend"),
    )
    return rides.withColumn("price_multiplier", R.clip_multiplier(formula + residual))


def rides_from_events(events: DataFrame, hourly: DataFrame | None = None) -> DataFrame:
    """The ride table, as a lazy plan. ``hourly`` may be given to reuse a stored supply table.

    The join is left to Spark: it sends the hours to the events where they are few by
    measured bytes, and otherwise splits an hour that holds a large part of the events.
    """
    supply = hourly_supply(events) if hourly is None else hourly
    columns = event_columns()
    base = events.select(_hour_bucket().alias(HOUR), *[c.alias(n) for n, c in columns.items()])
    # A left join keeps events without a time; their demand and supply are unknown.
    return with_multiplier(base.join(supply, HOUR, "left")).select(*RIDES.fieldNames())


def stored_hourly(events: DataFrame) -> DataFrame:
    """The hourly supply as a written table, for plans that use it more than once."""
    return materialize(hourly_supply(events), "hourly")


def load_rides(spark: SparkSession, folder: str) -> DataFrame:
    return rides_from_events(read_events(spark, folder))
