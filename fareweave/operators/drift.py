"""Distribution drift of many columns between a reference and a current table.

All columns are counted in one scan as (feature, value) pairs with two counters.
The counts are written once; every statistic is then computed from them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fareweave import config
from fareweave.functions.pvalues import exact_ks_p_values, p_values
from fareweave.operators.counts import IS_REF, PART, flagged_counts, in_ranges, paired_counts
from fareweave.schema import categorical_columns, numeric_columns
from fareweave.storage import materialize
from pyspark.sql import types as T

ROWS = "_rows"
DISTANCES = ["wasserstein", "jensen_shannon"]
P_TESTS = ["ks", "chi_square", "z"]
ORDERED = ["wasserstein", "ks"]


@dataclass(frozen=True)
class DriftOptions:
    """Thresholds, the choice of test and the rule for the whole table."""

    threshold: float = config.DRIFT_THRESHOLD
    p_threshold: float = config.DRIFT_P_VALUE
    few_values: int = config.FEW_VALUES
    # large: distances; small: p-values. The caller says which; the size of a table does not.
    route: str = "large"
    # Kolmogorov-Smirnov p-values of the small route: from the limiting distribution, or counted
    # exactly, ties included. That takes (n + m) * n steps and all distinct values of a column in one row.
    exact_ks: bool = False
    # any, min_features or share.
    policy: str = "any"
    min_features: int = config.ALERT_FEATURES
    min_share: float = 0.5
    # Ranges that the counts are dealt into; by their bytes if not given.
    parts: int | None = None


def drift_columns(
    reference: DataFrame, current: DataFrame, skip: list[str] | None = None
) -> list[str]:
    """Shared numeric, boolean and string columns, in reference order."""
    skip = skip or []
    booleans = [f.name for f in reference.schema.fields if isinstance(f.dataType, T.BooleanType)]
    usable = set(numeric_columns(reference) + categorical_columns(reference) + booleans)
    shared = set(current.columns)
    return [c for c in reference.columns if c in usable and c in shared and c not in skip]


def finite_columns(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Numbers as double, infinities as missing, and a constant column that counts rows."""
    text = categorical_columns(df)
    out = []
    for c in columns:
        if c in text:
            out.append(F.col(c))
        else:
            x = F.col(c).cast("double")
            out.append(F.when(F.abs(x) < math.inf, x).alias(c))
    return df.select(*(keep or []), *out, F.lit(1.0).alias(ROWS))


def count_pairs(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """The written counts table of two tables over some columns."""
    text = [c for c in columns if c in categorical_columns(reference)]
    numeric = [c for c in columns if c not in text]
    counts = paired_counts(
        finite_columns(reference, columns), finite_columns(current, columns), [*numeric, ROWS], text
    )
    return materialize(counts, "drift-counts")


def count_split(df: DataFrame, is_reference: Column, columns: list[str]) -> DataFrame:
    """The written counts table of two parts of one table, from a single scan.

    Rows for which the condition is NULL belong to neither part.
    """
    text = [c for c in columns if c in categorical_columns(df)]
    numeric = [c for c in columns if c not in text]
    flagged = df.withColumn(IS_REF, is_reference).where(F.col(IS_REF).isNotNull())
    ready = finite_columns(flagged, columns, [IS_REF])
    return materialize(flagged_counts(ready, [*numeric, ROWS], text), "drift-counts")


def profile(counts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per (keys, feature): rows on both sides, distinct values, type and reference mean."""
    keys = keys or []
    return counts.groupBy(*keys, "feature").agg(
        F.sum("n_ref").alias("ref_rows"),
        F.sum("n_cur").alias("cur_rows"),
        F.count(F.lit(1)).alias("distinct_values"),
        F.bool_or(F.col("v").isNotNull()).alias("is_text"),
        F.try_divide(F.sum(F.col("x") * F.col("n_ref")), F.sum("n_ref")).alias("ref_mean"),
    )


def choose_test(options: DriftOptions) -> Column:
    """The test of a profiled column, from its type, its distinct values and the route."""
    distinct = F.col("distinct_values")
    category = F.col("is_text") | (distinct <= options.few_values)
    distance = F.when(category, "jensen_shannon").otherwise("wasserstein")
    by_p = F.when(category & (distinct <= 2), "z").when(category, "chi_square").otherwise("ks")
    if options.route not in ("large", "small"):
        raise ValueError(f"unknown route {options.route!r}")
    return distance if options.route == "large" else by_p


def route_tests(counts: DataFrame, options: DriftOptions, keys: list[str] | None = None) -> DataFrame:
    """Profile plus the chosen test, one row per (keys, feature)."""
    return profile(counts, keys).where(F.col("feature") != ROWS).withColumn("test", choose_test(options))


def ordered_statistics(
    ranged: DataFrame, tests: DataFrame, keys: list[str] | None = None
) -> DataFrame:
    """Wasserstein-1 distance, its reference spread and the Kolmogorov-Smirnov distance.

    ``ranged`` are counts in consecutive ranges. Cumulative shares run over the sorted
    values of each range and start from the totals of the ranges before it, so no feature
    has to fit into one task. ``tests`` has one row per (keys, feature).
    """
    keys = keys or []
    group = [*keys, "feature"]
    rows = ranged.join(tests, group)
    inside = W.partitionBy(*group, PART).orderBy("x")
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy(*group).orderBy(PART)
    earlier = before.rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*group, PART)
        .agg(F.sum("n_ref").alias("_r"), F.sum("n_cur").alias("_c"), F.min("x").alias("_x"))
        .select(
            *group,
            PART,
            F.coalesce(F.sum("_r").over(earlier), F.lit(0)).alias("base_ref"),
            F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("base_cur"),
            F.lead("_x").over(before).alias("next_x"),
        )
    )
    rows = rows.join(offsets, [*group, PART])
    gap = F.coalesce(F.lead("x").over(inside), F.col("next_x")) - F.col("x")
    share_ref = F.try_divide(F.col("base_ref") + F.sum("n_ref").over(upto), F.col("ref_rows"))
    share_cur = F.try_divide(F.col("base_cur") + F.sum("n_cur").over(upto), F.col("cur_rows"))
    deviation = F.col("x") - F.col("ref_mean")
    return (
        rows.select(
            *group,
            "ref_rows",
            F.abs(share_ref - share_cur).alias("_d"),
            gap.alias("_gap"),
            (F.col("n_ref") * deviation * deviation).alias("_s"),
        )
        .groupBy(*group)
        .agg(
            F.sum(F.col("_d") * F.coalesce(F.col("_gap"), F.lit(0.0))).alias("w1"),
            F.sqrt(F.try_divide(F.sum("_s"), F.max("ref_rows"))).alias("ref_std"),
            F.max("_d").alias("ks"),
        )
        .withColumn("wasserstein", F.col("w1") / F.greatest(F.col("ref_std"), F.lit(0.001)))
    )


def category_statistics(
    counts: DataFrame, tests: DataFrame, keys: list[str] | None = None
) -> DataFrame:
    """Jensen-Shannon distance, chi-square statistic and two-proportion z per feature."""
    keys = keys or []
    group = [*keys, "feature"]
    rows = counts.join(tests, group)
    p = F.try_divide(F.col("n_ref"), F.col("ref_rows"))
    q = F.try_divide(F.col("n_cur"), F.col("cur_rows"))
    mean = (p + q) / 2

    def part(share: Column) -> Column:
        return F.when(share > 0, share * F.ln(share / mean)).when(share == 0, 0.0)

    expected = p * F.col("cur_rows")
    off = (F.col("n_cur") - expected) * (F.col("n_cur") - expected)
    chi = F.when(expected > 0, off / expected).when(F.col("n_cur") > 0, F.lit(math.inf)).otherwise(0.0)
    value = F.struct("x", "v")
    first_ref = F.min_by(p, value)
    first_cur = F.min_by(q, value)
    n, m = F.max("ref_rows"), F.max("cur_rows")
    pooled = F.min_by(
        F.try_divide(F.col("n_ref") + F.col("n_cur"), F.col("ref_rows") + F.col("cur_rows")), value
    )
    spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), n) + F.try_divide(F.lit(1.0), m)))
    both = (n > 0) & (m > 0)
    return rows.groupBy(*group).agg(
        F.when(both, F.sqrt(F.greatest(F.lit(0.0), F.sum(part(p) + part(q)) / 2))).alias("jensen_shannon"),
        F.when(both, F.sum(chi)).alias("chi_square"),
        F.when(both, F.coalesce(F.try_divide(first_cur - first_ref, spread), F.lit(0.0))).alias("z"),
    )


REPORT_COLUMNS = [
    "position",
    "feature",
    "test",
    "statistic",
    "score",
    "threshold",
    "drift_detected",
    "reference_rows",
    "current_rows",
]


def score_counts(
    counts: DataFrame,
    columns: list[str],
    options: DriftOptions = DriftOptions(),
    keys: list[str] | None = None,
) -> DataFrame:
    """The drift report of a written counts table: one row per (keys, feature).

    The score is the distance for the distance tests and the p-value for the others. A
    column without values has no test and no drift. The profile, one row per (keys,
    feature), is written once; the driver reads nothing.
    """
    keys = keys or []
    group = [*keys, "feature"]
    tested = materialize(profile(counts, keys).withColumn("test", choose_test(options)), "profile")
    tests = tested.where(F.col("feature") != ROWS)
    is_ordered = F.col("test").isin(ORDERED)
    values = counts.where(F.col("x").isNotNull() & (F.col("feature") != ROWS))
    by_order = ordered_statistics(in_ranges(values, keys, options.parts), tests.where(is_ordered), keys)
    by_category = category_statistics(counts, tests.where(~is_ordered), keys)
    joined = (
        _all_features(tested, columns, keys)
        .join(tests, group, "left")
        .join(by_order, group, "left")
        .join(by_category, group, "left")
    )
    if options.route == "small" and options.exact_ks:
        by_value = F.sort_array(F.collect_list(F.struct("x", (F.col("n_ref") + F.col("n_cur")).alias("n"))))
        sizes = values.join(tests.where("test = 'ks'").select(*group), group).groupBy(*group).agg(by_value.alias("_v"))
        joined = joined.join(sizes.select(*group, F.transform("_v", lambda v: v["n"]).alias("ties")), group, "left")
    return judged(joined, options, keys)


def judged(measured: DataFrame, options: DriftOptions, keys: list[str]) -> DataFrame:
    """The report columns from the chosen test and the statistics of each (keys, feature)."""
    statistic = F.lit(None).cast("double")
    for test in [*DISTANCES, *P_TESTS]:
        statistic = F.when(F.col("test") == test, F.col(test)).otherwise(statistic)
    report = measured.withColumn("statistic", statistic)
    if options.route == "small":
        p = p_values("test", "statistic", "ref_rows", "cur_rows", "distinct_values")
        if options.exact_ks and "ties" in measured.columns:
            p = F.when(F.col("test") == "ks", exact_ks_p_values("ties", "ref_rows", "cur_rows", "statistic")).otherwise(p)
        report = report.withColumn("_p", F.when(F.col("test").isin(P_TESTS), p))
    else:
        report = report.withColumn("_p", F.lit(None).cast("double"))
    by_p = F.col("test").isin(P_TESTS)
    limit = F.when(by_p, options.p_threshold).when(F.col("test").isNotNull(), options.threshold)
    drift = F.when(by_p, F.col("_p") < limit).otherwise(F.col("statistic") >= limit)
    return report.withColumns(
        {
            "score": F.when(by_p, F.col("_p")).otherwise(F.col("statistic")),
            "threshold": limit,
            "drift_detected": F.coalesce(drift, F.lit(False)),
        }
    ).select(*keys, *REPORT_COLUMNS)


def _all_features(tested: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Every requested column with its position and the table sizes, also without values."""
    totals = tested.where(F.col("feature") == ROWS)
    sizes = [F.coalesce(F.max(c), F.lit(0).cast("long")) for c in ("ref_rows", "cur_rows")]
    totals = totals.groupBy(*keys).agg(sizes[0].alias("reference_rows"), sizes[1].alias("current_rows"))
    listed = F.array(*[F.lit(c) for c in columns]).cast("array<string>")
    return totals.select(
        *keys, F.posexplode(listed).alias("position", "feature"), "reference_rows", "current_rows"
    )


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    columns: list[str] | None = None,
    options: DriftOptions = DriftOptions(),
) -> DataFrame:
    """Compare all shared columns (or the given ones) of two tables."""
    names = drift_columns(reference, current) if columns is None else columns
    return score_counts(count_pairs(reference, current, names), names, options)


def dataset_rule(options: DriftOptions) -> Column:
    """Whether the whole table counts as drifted, from ``n_drifted_features`` and ``_n``."""
    n = F.col("n_drifted_features")
    if options.policy == "any":
        return n > 0
    if options.policy == "min_features":
        return n >= options.min_features
    if options.policy == "share":
        return n >= F.lit(options.min_share) * F.col("_n")
    raise ValueError(f"unknown policy {options.policy!r}")


def summarize(
    report: DataFrame, options: DriftOptions = DriftOptions(), keys: list[str] | None = None
) -> DataFrame:
    """One row per run (or key): table sizes, verdict, drifted features in column order."""
    keys = keys or []
    drifted = F.collect_list(F.when(F.col("drift_detected"), F.struct("position", "feature")))
    entry = F.struct("feature", F.struct("drift_detected", F.col("score").alias("drift_score")))
    return (
        report.groupBy(*keys)
        .agg(
            F.max("reference_rows").alias("reference_rows"),
            F.max("current_rows").alias("current_rows"),
            F.count_if("drift_detected").alias("n_drifted_features"),
            F.transform(F.array_sort(drifted), lambda d: d["feature"]).alias("drifted_features"),
            F.map_from_entries(F.collect_list(entry)).alias("drift_scores"),
            F.count(F.lit(1)).alias("_n"),
        )
        .withColumn("dataset_drift", dataset_rule(options))
        .select(
            *keys,
            "reference_rows",
            "current_rows",
            "dataset_drift",
            "n_drifted_features",
            "drifted_features",
            "drift_scores",
        )
    )


def stamp(summary: DataFrame, run_time: str) -> DataFrame:
    """Add the run time, which the caller gives so that a run can be repeated."""
    return summary.select(F.lit(run_time).cast("timestamp").alias("run_time"), "*")
