"""Exact quantiles from the counts of distinct values.

Values are counted before anything is ordered. The counts are dealt into consecutive
ranges; a value's ranks follow from the totals of the ranges before its own and a running
sum inside, so no column has to fit into one task and nothing depends on its size.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fareweave.functions.numeric import nan_to_null
from fareweave.operators.counts import PART, in_ranges, value_counts


def neighbours(
    df: DataFrame, columns: list[str], probabilities: list[float], parts: int | None = None
) -> DataFrame:
    """Per column with values: ``size`` and, for the i-th probability, the values ``low_i`` and ``high_i`` around it."""
    values = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in columns])
    return neighbours_in_counts(value_counts(values, columns, []), probabilities, parts)


def neighbours_in_counts(counts: DataFrame, probabilities: list[float], parts: int | None = None) -> DataFrame:
    """``neighbours`` from rows per (feature, x)."""
    ranged = in_ranges(counts.select("feature", "x", "n"), parts=parts)
    earlier = W.partitionBy("feature").orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("feature", PART)
        .agg(F.sum("n").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("size", F.sum("_n").over(W.partitionBy("feature")))
        .drop("_n")
    )
    upto = W.partitionBy("feature", PART).orderBy("x").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = ranged.join(starts, ["feature", PART]).withColumn("_end", F.col("_start") + F.sum("n").over(upto))

    def at(rank):
        return F.max(F.when((rank >= F.col("_end") - F.col("n")) & (rank < F.col("_end")), F.col("x")))

    picked = [F.max("size").alias("size")]
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * (F.col("size") - 1)
        picked += [at(F.floor(position)).alias(f"low_{i}"), at(F.ceil(position)).alias(f"high_{i}")]
    return ranked.groupBy("feature").agg(*picked)


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], parts: int | None = None
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation between the two neighbouring values.

    NULL and NaN are skipped; a column without values gives None. The driver reads one
    row per column.
    """
    if not columns:
        return {}
    return _interpolated(neighbours(df, columns, probabilities, parts), columns, probabilities)


def quantiles_of_counts(counts: DataFrame, columns: list[str], probabilities: list[float]) -> dict[str, list[float | None]]:
    """``exact_quantiles`` from rows per (feature, x), which are not counted again."""
    if not columns:
        return {}
    mine = counts.where(F.col("feature").isin(columns) & F.col("x").isNotNull())
    return _interpolated(neighbours_in_counts(mine, probabilities), columns, probabilities)


def _interpolated(found: DataFrame, columns: list[str], probabilities: list[float]) -> dict[str, list[float | None]]:
    found = {r["feature"]: r for r in found.collect()}
    out: dict[str, list[float | None]] = {}
    for c in columns:
        if c not in found:
            out[c] = [None] * len(probabilities)
            continue
        out[c] = []
        for i, p in enumerate(probabilities):
            position = p * (found[c]["size"] - 1)
            low, high = found[c][f"low_{i}"], found[c][f"high_{i}"]
            out[c].append(low + (high - low) * (position - math.floor(position)) if high != low else low)
    return out
