"""One-hot encoding and standard scaling with fitted state."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareweave.functions.rides import WEATHER_SEVERITY
from fareweave.operators.counts import long_values


class TooManyCategories(ValueError):
    """A column has more distinct values than one-hot encoding can hold."""


def category_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-missing values per column."""
    return (
        long_values(df, [], columns)
        .select(F.col("feature").alias("column_name"), F.col("v").alias("category"))
        .distinct()
    )


@dataclass(frozen=True)
class OneHotEncoder:
    """Sorted categories per column."""

    categories: dict[str, tuple[str, ...]]

    def names(self) -> list[str]:
        return [f"{c}_{v}" for c, values in self.categories.items() for v in values]

    def indicators(self) -> dict[str, Column]:
        return {
            f"{c}_{v}": F.when(F.col(c) == v, 1.0).otherwise(0.0)
            for c, values in self.categories.items()
            for v in values
        }

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace each column by its indicators; unknown and NULL give all zeros."""
        return df.withColumns(self.indicators()).drop(*self.categories)


def fit_one_hot(df: DataFrame, columns: list[str], max_categories: int) -> OneHotEncoder:
    """Learn the categories, each of which becomes a column.

    The caller says how many columns a table may get; a column with more categories is an
    error. ``category_table`` lists any number of them without the driver.
    """
    return one_hot_of(category_table(df, columns), columns, max_categories)


def one_hot_of(listed: DataFrame, columns: list[str], max_categories: int) -> OneHotEncoder:
    """The encoder of a table (column_name, category) of distinct categories."""
    limit = max_categories * len(columns) + 1
    rows = listed.limit(limit).collect()
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in rows:
        found[row["column_name"]].append(row["category"])
    crowded = [c for c, values in found.items() if len(values) > max_categories]
    if crowded or len(rows) == limit:
        raise TooManyCategories(f"more than {max_categories} categories in {crowded or columns}")
    return OneHotEncoder({c: tuple(sorted(values)) for c, values in found.items()})


def ordinal_from_one_hot(
    df: DataFrame, column: str, scores: dict[str, int], name: str
) -> DataFrame:
    """Rebuild an ordinal score from indicator columns, always from scratch.

    Without any indicator column the table is returned as it is.
    """
    present = [(v, s) for v, s in scores.items() if f"{column}_{v}" in df.columns]
    if not present:
        return df
    total = F.lit(0.0)
    for value, score in present:
        total = total + F.col(f"{column}_{value}") * F.lit(float(score))
    return df.withColumn(name, total.cast("int"))


def severity_from_one_hot(df: DataFrame) -> DataFrame:
    return ordinal_from_one_hot(df, "weather_condition", WEATHER_SEVERITY, "weather_severity_score")


@dataclass(frozen=True)
class StandardScaler:
    """Mean and population standard deviation per column."""

    means: dict[str, float | None]
    stds: dict[str, float | None]

    def transform(self, df: DataFrame) -> DataFrame:
        """Centre and divide. A constant column is only centred; an unknown mean gives NULL."""
        scaled = {}
        for name, mean in self.means.items():
            std = self.stds[name] or 1.0
            c = F.col(name).cast("double")
            # A factor, since a division is compiled with a check for zero in every row.
            scaled[name] = (c - F.lit(mean).cast("double")) * F.lit(1.0 / std)
        return df.withColumns(scaled) if scaled else df


def scaler_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column with values: mean and population std, missing values skipped.

    Columns become rows first: one aggregate over many columns would compile to a
    method too large for the JVM to optimise.
    """
    return (
        long_values(df, columns, [])
        .groupBy(F.col("feature").alias("column_name"))
        .agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"))
    )


def fit_scaler(df: DataFrame, columns: list[str]) -> StandardScaler:
    if not columns:
        return StandardScaler({}, {})
    rows = {r["column_name"]: r for r in scaler_stats(df, columns).collect()}
    return StandardScaler(
        {c: rows[c]["mean"] if c in rows else None for c in columns},
        {c: rows[c]["std"] if c in rows else None for c in columns},
    )
