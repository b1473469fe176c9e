"""Counts of distinct values for many columns in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareweave.functions.numeric import nan_to_null
from fareweave.storage import materialize


def _unpivoted(df: DataFrame, columns: list[str], keep: list[str], as_text: bool) -> DataFrame:
    if as_text:
        long = df.select(*keep, *columns).unpivot(keep, columns, "feature", "v")
        found = long.where(F.col("v").isNotNull()).withColumn("x", F.lit(None).cast("double"))
    else:
        numbers = [nan_to_null(F.col(c).cast("double")).alias(c) for c in columns]
        long = df.select(*keep, *numbers).unpivot(keep, columns, "feature", "x")
        found = long.where(F.col("x").isNotNull()).withColumn("v", F.lit(None).cast("string"))
    return found.select(*keep, "feature", "x", "v")


def long_values(
    df: DataFrame, numeric: list[str], text: list[str], keep: list[str] | None = None
) -> DataFrame:
    """One row per input row and column: ``feature`` with ``x`` (number) or ``v`` (text).

    Missing values are dropped. Numbers and texts are two branches of a union that scan
    disjoint columns.
    """
    keep = keep or []
    if not text:
        return _unpivoted(df, numeric, keep, as_text=False)
    if not numeric:
        return _unpivoted(df, text, keep, as_text=True)
    return _unpivoted(df, numeric, keep, False).unionByName(_unpivoted(df, text, keep, True))


def value_counts(
    df: DataFrame, numeric: list[str], text: list[str], keys: list[str] | None = None
) -> DataFrame:
    """Rows per (keys, feature, value). Counting starts before the shuffle."""
    keys = keys or []
    long = long_values(df, numeric, text, keys)
    return long.groupBy(*keys, "feature", "x", "v").agg(F.count(F.lit(1)).alias("n"))


IS_REF = "_ref"


def flagged_counts(df: DataFrame, numeric: list[str], text: list[str]) -> DataFrame:
    """Rows per (feature, value) with (``n_ref``) and without (``n_cur``) the flag ``_ref``."""
    return (
        long_values(df, numeric, text, [IS_REF])
        .groupBy("feature", "x", "v")
        .agg(F.count_if(IS_REF).alias("n_ref"), F.count_if(~F.col(IS_REF)).alias("n_cur"))
    )


def paired_counts(
    reference: DataFrame, current: DataFrame, numeric: list[str], text: list[str]
) -> DataFrame:
    """Rows per (feature, value) in a reference and a current table: ``n_ref``, ``n_cur``."""
    names = numeric + text
    tagged = reference.select(*names, F.lit(True).alias(IS_REF)).unionByName(
        current.select(*names, F.lit(False).alias(IS_REF))
    )
    return flagged_counts(tagged, numeric, text)


PART = "part"


def in_ranges(counts: DataFrame, keys: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """Written counts with ``part``: consecutive ranges of (keys, feature, x).

    Spark samples the ranges and sizes them by bytes, so a feature of any number of values
    is spread over as many parts as it needs; ``parts`` asks for a number of them instead.
    """
    order = [*(keys or []), "feature", "x"]
    ranged = counts.repartitionByRange(parts, *order) if parts else counts.repartitionByRange(*order)
    return materialize(ranged.withColumn(PART, F.spark_partition_id()), "ranged-counts")
