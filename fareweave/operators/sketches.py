"""Quantiles from mergeable KLL sketches: one small binary per part and column.

A sketch is made where its rows are, stored with its part (a day, a file, a partition) and merged
with others later, so that quantiles of any union of parts come without reading rows again.
An estimate's rank is off by at most ``rank_error(k)`` of the rows, with 99 % confidence for
each estimate, however many sketches were merged. Exact quantiles are in ``quantiles``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 2048
ROWS_OF = "n"


def rank_error(k: int = K) -> float:
    """The part of the rows by which the rank of an estimate may be off: the published bound of these sketches."""
    return 2.296 / k**0.9723


def sketch_columns(df: DataFrame, columns: list[str], by: list[str] | None = None, k: int = K) -> DataFrame:
    """(by, feature, n, sketch): a sketch of each column in each part, from one scan. NULL and NaN are skipped.

    A column without values in a part has a null sketch and n = 0.
    """
    by = by or []
    known = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    made = df.groupBy(*by).agg(
        *[
            F.struct(F.count(x).alias(ROWS_OF), F.kll_sketch_agg_double(x, k).alias("sketch")).alias(c)
            for c, x in known.items()
        ]
    )
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("_of")) for c in columns]))
    long = made.select(*by, rows.alias("_row"))
    n = F.col(f"_row._of.{ROWS_OF}")
    return long.select(*by, "_row.feature", n.alias(ROWS_OF), F.when(n > 0, F.col("_row._of.sketch")).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: list[str] | None = None, k: int = K) -> DataFrame:
    """One sketch per (by, feature) from the sketches of finer parts."""
    return sketches.groupBy(*(by or []), "feature").agg(
        F.sum(ROWS_OF).alias(ROWS_OF), F.kll_merge_agg_double("sketch", k).alias("sketch")
    )


def sketch_quantiles(sketches: DataFrame, probabilities: list[float]) -> DataFrame:
    """The sketches' rows with ``quantiles``, one estimate per probability; null without values."""
    asked = F.array(*[F.lit(float(p)) for p in probabilities])
    return sketches.withColumn(
        "quantiles", F.when(F.col(ROWS_OF) > 0, F.kll_sketch_get_quantile_double("sketch", asked))
    )


def approx_quantiles(df: DataFrame, columns: list[str], probabilities: list[float], k: int = K) -> dict[str, list[float | None]]:
    """Like ``exact_quantiles``, within ``rank_error(k)`` and without ordering any value; the driver reads a row per column."""
    if not columns:
        return {}
    found = sketch_quantiles(sketch_columns(df, columns, k=k), probabilities).select("feature", "quantiles").collect()
    return {r["feature"]: list(r["quantiles"] or [None] * len(probabilities)) for r in found}


def approx_medians(df: DataFrame, columns: list[str], k: int = K) -> tuple[dict[str, float | None], dict[str, int]]:
    """The estimated median and the number of known values of each column, from one scan."""
    if not columns:
        return {}, {}
    found = sketch_quantiles(sketch_columns(df, columns, k=k), [0.5]).select("feature", ROWS_OF, "quantiles").collect()
    return {r["feature"]: (r["quantiles"] or [None])[0] for r in found}, {r["feature"]: r[ROWS_OF] for r in found}
