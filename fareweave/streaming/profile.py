"""Feature profiles per closed event-time window of a stream."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fareweave.operators.counts import long_values
from fareweave.operators.drift import ROWS, finite_columns

WINDOW_START, WINDOW = "window_start", "_w"


def binned(df: DataFrame, widths: dict[str, float]) -> DataFrame:
    """Numbers replaced by the lower edge of their bin; infinite ones count as missing."""

    def edge(column: str, width: float) -> Column:
        x = F.col(column).cast("double")
        return F.when(F.abs(x) < math.inf, F.floor(x / F.lit(width)) * F.lit(width))

    return df.withColumns({c: edge(c, w) for c, w in widths.items()})


def windowed_profile(
    stream: DataFrame,
    time_column: str,
    widths: dict[str, float],
    text: list[str],
    window: str = "1 day",
    delay: str = "1 hour",
) -> DataFrame:
    """Rows per (window, feature, bin). Rows later than the watermark are dropped.

    A column ``_rows`` counts the rows of the window. ``_w`` is the window itself, for further
    aggregation in the same stream.
    """
    timed = stream.withColumn("_time", F.col(time_column).cast("timestamp")).withWatermark("_time", delay)
    ready = binned(timed, widths).withColumn(ROWS, F.lit(1.0))
    long = long_values(ready, [*widths, ROWS], text, ["_time"])
    counted = long.groupBy(F.window("_time", window).alias(WINDOW), "feature", "x", "v").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.select(F.col("_w.start").alias(WINDOW_START), "feature", "x", "v", "n", WINDOW)


def start_profile(profile: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the counts of each window once it is closed."""
    return (
        profile.drop(WINDOW)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def baseline_profile(baseline: DataFrame, widths: dict[str, float], text: list[str]) -> DataFrame:
    """Counts per (feature, bin) of a static table, to compare windows with."""
    ready = finite_columns(binned(baseline, widths), [*widths, *text])
    return (
        long_values(ready, [*widths, ROWS], text)
        .groupBy("feature", "x", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
