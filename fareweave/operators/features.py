"""Engineered ride features. One function serves training, batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareweave.functions import rides as R
from fareweave.operators.encode import severity_from_one_hot

ENGINEERED = [
    "demand_supply_ratio",
    "is_rush_hour",
    "weather_severity_score",
    "hour_sin",
    "hour_cos",
    "is_night",
    "demand_weather_interaction",
    "fare_per_driver",
]


def add_ratio(df: DataFrame) -> DataFrame:
    ratio = R.demand_supply_ratio(F.col("passenger_demand"), F.col("driver_availability"))
    return df.withColumn("demand_supply_ratio", ratio)


def add_rush_hour(df: DataFrame) -> DataFrame:
    return df.withColumn("is_rush_hour", R.is_rush_hour(F.col("hour_of_day")))


def add_severity(df: DataFrame) -> DataFrame:
    """Severity from the weather column, or from its indicators where it is already encoded."""
    if "weather_condition" in df.columns:
        severity = R.weather_severity(F.col("weather_condition"))
        return df.withColumn("weather_severity_score", severity)
    return severity_from_one_hot(df)


def add_time(df: DataFrame) -> DataFrame:
    hour = F.col("hour_of_day")
    sine, cosine = R.hour_cycle(hour)
    return df.withColumns({"hour_sin": sine, "hour_cos": cosine, "is_night": R.is_night(hour)})


def add_interactions(df: DataFrame) -> DataFrame:
    added = {
        "fare_per_driver": R.fare_per_driver(F.col("base_fare"), F.col("driver_availability"))
    }
    if "weather_severity_score" in df.columns:
        product = F.col("passenger_demand").cast("double") * F.col("weather_severity_score")
        added = {"demand_weather_interaction": product, **added}
    return df.withColumns(added)


def add_features(df: DataFrame) -> DataFrame:
    """All engineered features, from raw (unscaled) columns. Repeating it changes nothing."""
    return (
        df.transform(add_ratio)
        .transform(add_rush_hour)
        .transform(add_severity)
        .transform(add_time)
        .transform(add_interactions)
    )
