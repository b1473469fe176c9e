"""Windowed profiles that lose no row: closed windows, open windows, and a table of the rows that came too late.

Each micro-batch writes folders of its own, in overwrite mode, and its progress last, so a batch
that is repeated changes nothing. Below ``out``:

* ``windows/batch_id=i/closed=true``: the counts of the windows that batch i closed,
* ``windows/batch_id=i/closed=false``: the counts of all windows open after batch i (earlier ones are deleted),
* ``late/batch_id=i``: rows whose window was closed before batch i, or that have no time, as they came,
* ``progress/batch_id=i``: one row with the watermark and the rows counted so far.

A window is closed once the latest time seen, less the delay, reaches its end.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fareweave.operators.counts import long_values
from fareweave.operators.drift import ROWS
from fareweave.storage import delete_path
from fareweave.streaming.profile import WINDOW_START, binned

PROGRESS = (
    "batch_id bigint, watermark timestamp, latest timestamp, rows_in bigint, rows_kept bigint, rows_late bigint, rows_untimed bigint"
)
COUNTS = f"{WINDOW_START} timestamp, window_end timestamp, feature string, x double, v string, n bigint"


@dataclass(frozen=True)
class WindowTables:
    """What a stream of windows has written below ``out``."""

    spark: SparkSession
    out: str

    def folder(self, table: str, batch_id: int) -> str:
        return f"{self.out.rstrip('/')}/{table}/batch_id={batch_id}"

    def _read(self, path: str, schema: str, base: str | None = None) -> DataFrame:
        try:
            reader = self.spark.read.schema(schema)
            return (reader.option("basePath", base) if base else reader).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def progress(self) -> DataFrame:
        """One row per batch: the watermark after it and the rows of the stream so far, by what became of them."""
        return self._read(f"{self.out.rstrip('/')}/progress", PROGRESS)

    def closed(self) -> DataFrame:
        """(window_start, window_end, feature, x, v, n) of closed windows, each counted by one batch."""
        root = f"{self.out.rstrip('/')}/windows"
        return self._read(root, f"{COUNTS}, batch_id bigint, closed boolean").where("closed").drop("closed", "batch_id")

    def open(self) -> DataFrame:
        """The counts of the windows that are open after the last batch."""
        last = self.progress().agg(F.max("batch_id")).first()[0]
        return self.open_after(-1 if last is None else last)

    def open_after(self, batch_id: int) -> DataFrame:
        return self._read(f"{self.folder('windows', batch_id)}/closed=false", COUNTS)

    def late(self) -> DataFrame:
        """The rows that no window counts, with ``window_start`` and ``reason``: ``late`` or ``no_time``."""
        return self.spark.read.parquet(f"{self.out.rstrip('/')}/late")


def write_batch(
    tables: WindowTables, batch: DataFrame, batch_id: int, time_column: str, widths: dict[str, float], text: list[str],
    window: str, delay: str,
) -> None:
    """Count one micro-batch."""
    before = tables._read(tables.folder("progress", batch_id - 1), PROGRESS).first()
    watermark = F.lit(before["watermark"] if before else None).cast("timestamp")
    time = F.col(time_column).cast("timestamp")
    # The window of a row, also of one without a time.
    start = F.when(time.isNotNull(), F.window(F.coalesce(time, F.timestamp_seconds(F.lit(0))), window))
    tagged = batch.withColumn("_window", start).withColumns(
        {WINDOW_START: F.col("_window.start"), "window_end": F.col("_window.end")}
    ).drop("_window")
    untimed = F.col("window_end").isNull()
    is_late = F.coalesce(F.col("window_end") <= watermark, F.lit(False))
    tagged = tagged.withColumn("reason", F.when(untimed, "no_time").when(is_late, "late")).persist()
    try:
        seen = Observation()
        observed = tagged.observe(
            seen,
            F.count(F.lit(1)).alias("rows_in"), F.count_if(F.col("reason").isNull()).alias("rows_kept"),
            F.count_if(F.col("reason") == "late").alias("rows_late"), F.count_if(F.col("reason") == "no_time").alias("rows_untimed"),
            F.max(time).alias("latest"),
        )
        unkept = observed.where(F.col("reason").isNotNull()).drop("window_end")
        unkept.write.mode("overwrite").parquet(tables.folder("late", batch_id))
        new = seen.get
        spark = tables.spark
        keys = [WINDOW_START, "window_end"]
        ready = binned(tagged.where(F.col("reason").isNull()), widths).withColumn(ROWS, F.lit(1.0))
        counts = long_values(ready, [*widths, ROWS], text, keys).withColumn("n", F.lit(1).cast("long"))
        latest = max((t for t in (new["latest"], before["latest"] if before else None) if t is not None), default=None)
        row = {c: new[c] + (before[c] if before else 0) for c in ("rows_in", "rows_kept", "rows_late", "rows_untimed")}
        progress = spark.createDataFrame([(batch_id, None, latest, *row.values())], PROGRESS).withColumn(
            "watermark", F.col("latest") - F.expr(f"INTERVAL {delay}")
        )
        after = progress.first()["watermark"]
        over = F.coalesce(F.col("window_end") <= F.lit(after).cast("timestamp"), F.lit(False))
        merged = (
            tables.open_after(batch_id - 1)
            .unionByName(counts)
            .groupBy(*keys, "feature", "x", "v")
            .agg(F.sum("n").alias("n"))
        )
        flagged = merged.withColumn("closed", over)
        flagged.write.mode("overwrite").partitionBy("closed").parquet(tables.folder("windows", batch_id))
        progress.drop("batch_id").write.mode("overwrite").parquet(tables.folder("progress", batch_id))
        if batch_id >= 2:
            # The batch before stays: it is read again if this one is repeated.
            delete_path(spark, f"{tables.folder('windows', batch_id - 2)}/closed=false")
    finally:
        tagged.unpersist()


def start_windows(
    stream: DataFrame,
    time_column: str,
    widths: dict[str, float],
    text: list[str],
    out: str,
    checkpoint: str,
    window: str = "1 day",
    delay: str = "1 hour",
) -> StreamingQuery:
    """Count rows per (window, feature, bin); rows of the stream = rows of closed and of open windows + late rows.

    A column ``_rows`` counts the rows of a window. Rows without a time are listed as such. The
    driver reads one row of progress per batch; the counts of open windows are written anew by
    each batch, so their number is bounded by windows open x bins.
    """
    tables = WindowTables(stream.sparkSession, out)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(tables, batch, batch_id, time_column, widths, text, window, delay)

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
