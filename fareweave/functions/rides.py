"""Column expressions of the ride domain: engineered features and the price formula."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareweave.config import MULTIPLIER_RANGE
from fareweave.functions.numeric import clip, cyclical, lookup

# Weather categories with their severity.
WEATHER_SEVERITY = {"clear": 0, "cloudy": 1, "rain": 2, "storm": 3, "snow": 4}
DEFAULT_SEVERITY = 1
WEATHER_PATTERN = "^(clear|cloudy|rain|storm|snow)$"

# Hour ranges, both ends included.
MORNING_RUSH = (7, 9)
EVENING_RUSH = (17, 19)
NIGHT_FROM = 22
NIGHT_TO = 5

# Terms of the price formula.
RATIO_WEIGHT = 0.3
SEVERITY_WEIGHT = 0.08
RUSH_WEIGHT = 0.15
WEEKEND_WEIGHT = 0.05


def _per_driver(amount: Column, drivers: Column) -> Column:
    return F.try_divide(amount.cast("double"), drivers.cast("double") + F.lit(1.0))


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def demand_supply_ratio(demand: Column, drivers: Column) -> Column:
    return _per_driver(demand, drivers)


def fare_per_driver(fare: Column, drivers: Column) -> Column:
    return _per_driver(fare, drivers)


def is_rush_hour(hour: Column) -> Column:
    return _flag(hour.between(*MORNING_RUSH) | hour.between(*EVENING_RUSH))


def is_night(hour: Column) -> Column:
    return _flag((hour >= NIGHT_FROM) | (hour <= NIGHT_TO))


def weather_severity(weather: Column) -> Column:
    return lookup(weather, WEATHER_SEVERITY, DEFAULT_SEVERITY)


def hour_cycle(hour: Column) -> tuple[Column, Column]:
    return cyclical(hour, 24)


def is_weekend(weekday: Column) -> Column:
    return weekday >= 5


def formula_multiplier(ratio: Column, severity: Column, rush: Column, weekend: Column) -> Column:
    """Price multiplier before clipping."""
    return (
        F.lit(1.0)
        + F.lit(RATIO_WEIGHT) * (ratio - F.lit(1.0))
        + F.lit(SEVERITY_WEIGHT) * severity
        + F.lit(RUSH_WEIGHT) * rush.cast("double")
        + F.lit(WEEKEND_WEIGHT) * weekend.cast("double")
    )


def clip_multiplier(c: Column) -> Column:
    return clip(c, *MULTIPLIER_RANGE)


def cyclic_fare(hour: Column) -> Column:
    """Base fare over the day, before clipping."""
    sine, _ = hour_cycle(hour)
    return F.lit(5.0) + F.lit(2.0) * sine


def clip_fare(c: Column) -> Column:
    return clip(c, 3.0, 12.0)


def confidence(p: Column) -> Column:
    """Confidence label of an unrounded multiplier; NULL stays NULL."""
    return (
        F.when(p.isNull(), F.lit(None).cast("string"))
        .when(p.between(1.3, 2.0), "medium")
        .when((p < 1.3) | (p > 2.5), "low")
        .otherwise("high")
    )
