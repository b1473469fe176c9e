"""What-if variants of a ride table."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareweave.functions.numeric import clip, truncate
from fareweave.operators.features import add_features


@dataclass(frozen=True)
class Scenario:
    """Changes to apply to every row; None leaves the column as it is."""

    name: str
    demand_factor: float | None = None
    driver_factor: float | None = None
    temperature_drop: float | None = None
    weather: str | None = None
    # SQL expressions over the raw columns, as (column, expression); they see the columns before any change.
    changes: tuple[tuple[str, str], ...] = ()


RULES = ["name", "demand_factor", "driver_factor", "temperature_drop", "weather"]

# Demand spikes by severity.
DEMAND_SPIKES = {
    "mild": Scenario("demand_mild", 1.5, 0.8, 2.0),
    "moderate": Scenario("demand_moderate", 2.5, 0.5, 5.0),
    "severe": Scenario("demand_severe", 4.0, 0.3, 10.0),
}
CONTROL = Scenario("control")
WEATHER_SHIFT = Scenario("weather_storm", weather="storm")
DEFAULT_SCENARIOS = [CONTROL, *DEMAND_SPIKES.values(), WEATHER_SHIFT]


def demand_spike(severity: str) -> Scenario:
    if severity not in DEMAND_SPIKES:
        raise ValueError(f"severity must be one of {list(DEMAND_SPIKES)}, not {severity!r}")
    return DEMAND_SPIKES[severity]


def _scaled(column: str, factor: Column) -> Column:
    """Multiply, keep at least 1, and cut the fraction."""
    scaled = truncate(clip(F.col(column).cast("double") * factor, low=1.0), "bigint")
    return F.when(factor.isNull(), F.col(column).cast("bigint")).otherwise(scaled)


def _changed(df: DataFrame, rule: dict[str, Column]) -> DataFrame:
    """Apply rule columns to the ride columns that are present, then redo the features."""
    changes = {}
    if "passenger_demand" in df.columns:
        changes["passenger_demand"] = _scaled("passenger_demand", rule["demand_factor"])
    if "driver_availability" in df.columns:
        changes["driver_availability"] = _scaled("driver_availability", rule["driver_factor"])
    if "temperature" in df.columns:
        drop = F.coalesce(rule["temperature_drop"], F.lit(0.0))
        changes["temperature"] = F.col("temperature") - drop
    if "weather_condition" in df.columns:
        changes["weather_condition"] = F.coalesce(rule["weather"], F.col("weather_condition"))
    return add_features(df.withColumns(changes))


def _literal(value, name: str) -> Column:
    kind = "string" if name in ("name", "weather") else "double"
    return F.lit(value).cast(kind)


def apply_scenario(df: DataFrame, scenario: Scenario) -> DataFrame:
    """One variant of a table with raw ride columns; engineered columns are recomputed."""
    changed = df.withColumns({c: F.expr(sql) for c, sql in scenario.changes})
    return _changed(changed, {n: _literal(getattr(scenario, n), n) for n in RULES})


def apply_scenarios(df: DataFrame, scenarios: list[Scenario]) -> DataFrame:
    """All variants at once with a leading ``scenario`` column, from a single scan; none may have ``changes``."""
    if any(s.changes for s in scenarios):
        raise ValueError("scenarios with expressions of their own are applied one by one")
    rules = [F.struct(*[_literal(getattr(s, n), n).alias(n) for n in RULES]) for s in scenarios]
    tagged = df.withColumn("_rule", F.explode(F.array(*rules)))
    changed = _changed(tagged, {n: F.col(f"_rule.{n}") for n in RULES})
    names = [c for c in changed.columns if c != "_rule"]
    return changed.select(F.col("_rule.name").alias("scenario"), *names)


def rename(scenario: Scenario, name: str) -> Scenario:
    return replace(scenario, name=name)
