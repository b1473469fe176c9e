"""Drift of each closed event-time window of a stream against a baseline.

One streaming plan from the rows to the report: Spark keeps the counts of open windows in keyed
state, hands a window on when the watermark passes its end, gathers its bins into one row, and
joins the static baseline, one row per feature. The statistics are one fold over the sorted bins of
both sides. Nothing is read by the driver, and no batch leaves files beside those of the sink.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fareweave.operators.drift import REPORT_COLUMNS, ROWS, DriftOptions, choose_test, judged
from fareweave.storage import materialize
from fareweave.streaming.profile import WINDOW, WINDOW_START

BIN = "array<struct<x: double, v: string, n: bigint>>"


def baseline_rows(baseline: DataFrame, columns: list[str]) -> DataFrame:
    """One row per monitored column: its position, its bins, its rows, mean and spread; written once.

    ``baseline`` has counts per (feature, x, v); a column that it lacks has no bins.
    """
    spark = baseline.sparkSession
    listed = spark.createDataFrame(list(enumerate([*columns, ROWS])), "position int, feature string")
    n = F.col("n")
    sums = baseline.groupBy("feature").agg(
        F.sum("n").alias("ref_rows"),
        F.try_divide(F.sum(F.col("x") * n), F.sum("n")).alias("ref_mean"),
        F.collect_list(F.struct("x", "v", "n")).cast(BIN).alias("base"),
    )
    off = F.aggregate(
        "base", F.lit(0.0), lambda s, b: s + F.coalesce(b["n"] * (b["x"] - F.col("ref_mean")) * (b["x"] - F.col("ref_mean")), F.lit(0.0))
    )
    rows = listed.join(sums.withColumn("ref_std", F.sqrt(F.try_divide(off, "ref_rows"))), "feature", "left")
    all_rows = F.max(F.when(F.col("feature") == ROWS, F.col("ref_rows"))).over(W.partitionBy())
    counted = rows.withColumn("reference_rows", F.coalesce(all_rows, F.lit(0).cast("long")))
    return materialize(counted.where(F.col("feature") != ROWS), "baseline-rows")


def _statistics(base: Column, bins: Column, ref_rows: Column, cur_rows: Column) -> Column:
    """All statistics of two lists of bins: a fold over the sorted bins of both, equal ones met as one."""
    one_side = F.transform(base, lambda b: F.struct(b["x"], b["v"], b["n"].alias("r"), F.lit(0).cast("long").alias("c")))
    other = F.transform(bins, lambda b: F.struct(b["x"], b["v"], F.lit(0).cast("long").alias("r"), b["n"].alias("c")))

    def part(share: Column, mean: Column) -> Column:
        return F.when(share > 0, share * F.ln(share / mean)).otherwise(0.0)

    def closed(a: Column) -> dict[str, Column]:
        """The sums after the bin that is open."""
        p, q = F.try_divide(a["r"], ref_rows), F.try_divide(a["c"], cur_rows)
        mean, expected = (p + q) / 2, p * cur_rows
        off = (a["c"] - expected) * (a["c"] - expected)
        chi = F.when(expected > 0, off / expected).when(a["c"] > 0, F.lit(math.inf)).otherwise(0.0)
        sum_r, sum_c = a["sum_r"] + a["r"], a["sum_c"] + a["c"]
        apart = F.abs(F.try_divide(sum_r, ref_rows) - F.try_divide(sum_c, cur_rows))
        return {
            "sum_r": sum_r, "sum_c": sum_c, "apart": F.coalesce(apart, F.lit(0.0)),
            "ks": F.greatest(a["ks"], F.coalesce(apart, F.lit(0.0))),
            "js": a["js"] + F.coalesce(part(p, mean) + part(q, mean), F.lit(0.0)),
            "chi": a["chi"] + F.coalesce(chi, F.lit(0.0)),
        }

    def state(values: dict[str, Column]) -> Column:
        kinds = {"x": "double", "v": "string", "w1": "double", "ks": "double", "js": "double", "chi": "double"}
        names = ["x", "v", "r", "c", "sum_r", "sum_c", "w1", "ks", "js", "chi", "first_r", "first_c", "keys"]
        return F.struct(*[values[n].cast(kinds.get(n, "long")).alias(n) for n in names])

    def add(a: Column, e: Column) -> Column:
        same = (a["keys"] > 0) & a["x"].eqNullSafe(e["x"]) & a["v"].eqNullSafe(e["v"])
        names = ["x", "v", "sum_r", "sum_c", "w1", "ks", "js", "chi", "keys"]
        first = a["keys"] <= 1
        r, c = a["r"] + e["r"], a["c"] + e["c"]
        grown = {
            **{n: a[n] for n in names}, "r": r, "c": c,
            "first_r": F.when(first, r).otherwise(a["first_r"]), "first_c": F.when(first, c).otherwise(a["first_c"]),
        }
        done = closed(a)
        gap = F.coalesce(e["x"] - a["x"], F.lit(0.0))
        new = {
            "x": e["x"], "v": e["v"], "r": e["r"], "c": e["c"], "keys": a["keys"] + 1,
            **{n: done[n] for n in ("sum_r", "sum_c", "ks", "js", "chi")},
            "w1": a["w1"] + done["apart"] * gap,
            "first_r": F.when(a["keys"] == 0, e["r"]).otherwise(a["first_r"]),
            "first_c": F.when(a["keys"] == 0, e["c"]).otherwise(a["first_c"]),
        }
        return F.when(same, state(grown)).otherwise(state(new))

    def finish(a: Column) -> Column:
        done = closed(a)
        n, m = ref_rows, cur_rows
        pooled = F.try_divide(a["first_r"] + a["first_c"], n + m)
        spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), n) + F.try_divide(F.lit(1.0), m)))
        z = F.try_divide(F.try_divide(a["first_c"], m) - F.try_divide(a["first_r"], n), spread)
        return F.struct(
            a["w1"].alias("w1"), done["ks"].alias("ks"), F.sqrt(F.greatest(F.lit(0.0), done["js"] / 2)).alias("js"),
            done["chi"].alias("chi"), F.coalesce(z, F.lit(0.0)).alias("z"), a["keys"].alias("keys"),
        )

    zero = {n: F.lit(0) for n in ("r", "c", "sum_r", "sum_c", "w1", "ks", "js", "chi", "first_r", "first_c", "keys")}
    start = state({**zero, "x": F.lit(None), "v": F.lit(None)})
    return F.aggregate(F.array_sort(F.concat(one_side, other)), start, add, finish)


def window_drift(profile: DataFrame, baseline: DataFrame, columns: list[str], options: DriftOptions = DriftOptions()) -> DataFrame:
    """The drift report of each window of a ``windowed_profile``: one row per (window, column).

    ``baseline`` holds counts as ``baseline_profile`` makes them. A row holds the bins of one
    window, whose number the widths of the bins bound. A column without values in a window,
    or in the baseline, has no statistic and no drift; one without any has no test.
    """
    static = baseline_rows(baseline, columns)
    entry = F.struct("feature", "x", "v", "n")
    windows = profile.groupBy(WINDOW).agg(F.collect_list(entry).alias("bins"))
    rows_of = F.filter("bins", lambda b: b["feature"] == ROWS)
    total = lambda bins: F.aggregate(bins, F.lit(0).cast("long"), lambda s, b: s + b["n"])
    listed = F.explode(F.array(*[F.lit(c) for c in columns]).cast("array<string>"))
    each = windows.select(F.col(f"{WINDOW}.start").alias(WINDOW_START), "bins", listed.alias("feature"))
    mine = F.filter("bins", lambda b: b["feature"] == F.col("feature"))
    counted = (
        each.withColumn("current_rows", total(rows_of))
        .withColumn("bins", F.transform(mine, lambda b: F.struct(b["x"].alias("x"), b["v"].alias("v"), b["n"].alias("n"))))
        .withColumn("cur_rows", total(F.col("bins")))
    )
    joined = counted.join(static, "feature").withColumns(
        {"ref_rows": F.coalesce("ref_rows", F.lit(0).cast("long")), "base": F.coalesce("base", F.array().cast(BIN))}
    )
    found = joined.withColumn("s", _statistics(F.col("base"), F.col("bins"), F.col("ref_rows"), F.col("cur_rows")))
    both = (F.col("ref_rows") > 0) & (F.col("cur_rows") > 0)
    is_text = F.exists(F.concat("base", "bins"), lambda b: b["v"].isNotNull())
    measured = found.withColumns(
        {
            "is_text": is_text,
            "distinct_values": F.col("s.keys"),
            "wasserstein": F.when(both, F.col("s.w1") / F.greatest(F.col("ref_std"), F.lit(0.001))),
            "ks": F.when(both, F.col("s.ks")),
            "jensen_shannon": F.when(both, F.col("s.js")),
            "chi_square": F.when(both, F.col("s.chi")),
            "z": F.when(both, F.col("s.z")),
        }
    )
    tested = measured.withColumn("test", F.when(F.col("distinct_values") > 0, choose_test(options)))
    return judged(tested, options, [WINDOW_START]).select(WINDOW_START, *REPORT_COLUMNS)


def start_drift(
    profile: DataFrame,
    baseline: DataFrame,
    columns: list[str],
    path: str,
    checkpoint: str,
    options: DriftOptions = DriftOptions(),
) -> StreamingQuery:
    """Append the report of each window once it is closed; the sink takes each batch once, also if it is repeated."""
    return (
        window_drift(profile, baseline, columns, options)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
