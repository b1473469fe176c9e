"""Profiles, data-quality rules and request validation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareweave.functions.numeric import missing, round_half_even
from fareweave.functions.rides import WEATHER_SEVERITY
from fareweave.operators.clean import column_counts
from fareweave.operators.counts import long_values
from fareweave.operators.quantiles import quantiles_of_counts
from fareweave.schema import MALFORMED, REQUEST, is_floating

QUARTILES = [0.25, 0.5, 0.75]


def _per_column(df: DataFrame, columns: list[str], *aggregates: Column) -> DataFrame:
    """Aggregates of the values ``x`` of each column that has any; one pass over the rows."""
    long = long_values(df, columns, [])
    return long.groupBy(F.col("feature").alias("column_name")).agg(*aggregates)


def describe(df: DataFrame, columns: list[str], decimals: int = 3) -> DataFrame:
    """Per column: count, mean, sample std, min, exact quartiles and max, rounded.

    One scan counts the values of all columns; everything else comes from the counts.
    """
    counts = column_counts(df, columns, []).where(F.col("feature").isin(columns))
    quartiles = quantiles_of_counts(counts, columns, QUARTILES)
    listed = df.sparkSession.createDataFrame(
        [(c, *quartiles[c]) for c in columns],
        "column_name string, p25 double, p50 double, p75 double",
    )
    n, x = F.col("n"), F.col("x")
    means = counts.groupBy(F.col("feature").alias("column_name")).agg(
        F.sum(n).alias("count"), (F.sum(x * n) / F.sum(n)).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max")
    )
    # The means have one row per column.
    off = counts.join(F.broadcast(means), F.col("feature") == F.col("column_name"))
    squares = off.groupBy("column_name").agg(F.sum(n * (x - F.col("mean")) * (x - F.col("mean"))).alias("_s"))
    std = F.when(F.col("count") > 1, F.sqrt(F.col("_s") / (F.col("count") - 1)))
    stats = means.join(F.broadcast(squares), "column_name").withColumn("std", std)
    # Both sides have one row per column.
    joined = listed.join(F.broadcast(stats), "column_name", "left")
    rounded = [
        round_half_even(F.col(n), decimals).alias(n)
        for n in ["mean", "std", "min", "p25", "p50", "p75", "max"]
    ]
    count = F.coalesce("count", F.lit(0).cast("long")).alias("count")
    return joined.select("column_name", count, *rounded)


def sample_std(df: DataFrame, columns: list[str]) -> DataFrame:
    """Sample standard deviation of each column with values."""
    return _per_column(df, columns, F.stddev_samp("x").alias("std"))


@dataclass(frozen=True)
class Rule:
    """A named condition every row has to meet; NULL counts as a violation."""

    name: str
    condition: Column


def range_rule(column: str, low: float, high: float) -> Rule:
    return Rule(f"{column}_range", F.col(column).between(low, high))


def positive_rule(column: str) -> Rule:
    return Rule(f"{column}_positive", F.col(column) > 0)


def domain_rule(column: str, values: list[str]) -> Rule:
    return Rule(f"{column}_domain", F.col(column).isin(values))


def no_missing_rule(df: DataFrame, columns: list[str]) -> Rule:
    condition = F.lit(True)
    for c in columns:
        condition = condition & ~missing(F.col(c), is_floating(df, c))
    return Rule("no_missing", condition)


def weekend_rule() -> Rule:
    """The weekend flag agrees with the weekday. Not part of the default rules."""
    return Rule("weekend_matches_weekday", F.col("is_weekend") == (F.col("day_of_week") >= 5))


def ride_rules(df: DataFrame) -> list[Rule]:
    return [
        range_rule("price_multiplier", 1.0, 3.0),
        range_rule("hour_of_day", 0, 23),
        range_rule("day_of_week", 0, 6),
        range_rule("temperature", -30, 50),
        positive_rule("visibility_km"),
        positive_rule("base_fare"),
        positive_rule("passenger_demand"),
        positive_rule("driver_availability"),
        domain_rule("weather_condition", ["clear", "cloudy", "rain", "storm", "snow"]),
        no_missing_rule(df, df.columns),
    ]


def check_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule with rows, violations and verdict, from a single pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(~F.coalesce(r.condition, F.lit(False))).alias(r.name) for r in rules],
    )
    return counted.unpivot(["_rows"], [r.name for r in rules], "rule", "violations").select(
        "rule",
        F.col("_rows").alias("row_count"),
        "violations",
        (F.col("violations") == 0).alias("passed"),
    )


def values_outside(df: DataFrame, column: str, domain: list[str]) -> DataFrame:
    """Values of a column that are not in its domain, with their row counts."""
    return (
        df.where(F.col(column).isNotNull() & ~F.col(column).isin(domain))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def domain_report(df: DataFrame, column: str, domain: list[str]) -> DataFrame:
    """Row counts of all values of a column and whether each is in the domain."""
    return (
        df.groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("in_domain", F.coalesce(F.col("value").isin(domain), F.lit(False)))
    )


# Accepted range per numeric request field (low, high, low excluded).
REQUEST_RANGES = {
    "hour_of_day": (0, 23, False),
    "day_of_week": (0, 6, False),
    "passenger_demand": (0, None, False),
    "driver_availability": (0, None, False),
    "visibility_km": (0, None, False),
    "base_fare": (0, None, True),
}

# Spellings of truth values accepted besides those of a SQL cast.
EXTRA_BOOLEANS = {"on": "true", "off": "false"}


def _typed(name: str, raw_type: T.DataType, to: T.DataType) -> Column:
    c = F.col(name)
    if raw_type == to:
        return c
    if isinstance(to, T.BooleanType) and isinstance(raw_type, T.StringType):
        for word, value in EXTRA_BOOLEANS.items():
            c = F.when(F.lower(F.trim(F.col(name))) == word, value).otherwise(c)
    if isinstance(raw_type, T.NumericType):
        # A fraction is no whole number, and of numbers only 0 and 1 are truth values.
        if isinstance(to, T.IntegralType):
            c = F.when(c == F.rint(c), c)
        elif isinstance(to, T.BooleanType):
            c = F.when(c.isin(0, 1), c)
    return c.try_cast(to)


def _in_range(name: str, value: Column, floating: bool) -> Column:
    if name == "weather_condition":
        return value.isin(*WEATHER_SEVERITY)
    if name not in REQUEST_RANGES:
        return F.lit(True)
    low, high, exclusive = REQUEST_RANGES[name]
    ok = value > low if exclusive else value >= low
    if high is not None:
        ok = ok & (value <= high)
    return ok & ~F.isnan(value) if floating else ok


def validate_requests(df: DataFrame) -> DataFrame:
    """Type the nine request fields and add ``errors`` (codes ``field:reason``) and ``valid``.

    Reasons are ``missing``, ``type`` (the text cannot be read as the type) and ``range``.
    A field that the table lacks is missing in every row. A row with text in
    ``malformed_document`` has the one error ``document:malformed``. Other columns pass through.
    """
    others = [c for c in df.columns if c not in REQUEST.fieldNames()]
    typed, errors = [], []
    for f in REQUEST.fields:
        if f.name not in df.columns:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            errors.append(F.lit(f"{f.name}:missing"))
            continue
        raw = F.col(f.name)
        value = _typed(f.name, df.schema[f.name].dataType, f.dataType)
        in_range = _in_range(f.name, value, isinstance(f.dataType, T.DoubleType))
        typed.append(value.alias(f.name))
        errors.append(
            F.when(raw.isNull(), F.lit(f"{f.name}:missing"))
            .when(value.isNull(), F.lit(f"{f.name}:type"))
            .when(~in_range, F.lit(f"{f.name}:range"))
        )
    found = F.array_compact(F.array(*errors))
    if MALFORMED in df.columns:
        found = F.when(F.col(MALFORMED).isNotNull(), F.array(F.lit("document:malformed"))).otherwise(found)
    return df.select(*others, *typed, found.alias("errors")).withColumn("valid", F.size("errors") == 0)


def split_requests(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted requests, and a quarantine table with the raw fields and the errors."""
    checked = validate_requests(df)
    accepted = checked.where("valid").drop("errors", "valid", MALFORMED)
    raw = [F.col(f"_raw.{c}").alias(c) for c in df.columns]
    kept = validate_requests(df.withColumn("_raw", F.struct(*df.columns)))
    rejected = kept.where(~F.col("valid")).select(*raw, "errors")
    return accepted, rejected
