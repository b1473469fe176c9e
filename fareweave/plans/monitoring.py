"""Drift monitoring: a baseline against current data, and against what-if scenarios."""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareweave import config
from fareweave.functions.rides import WEATHER_SEVERITY
from fareweave.operators.counts import value_counts
from fareweave.operators.drift import (
    ROWS,
    DriftOptions,
    drift_columns,
    drift_report,
    finite_columns,
    score_counts,
    stamp,
    summarize,
)
from fareweave.operators.split import exact_sample
from fareweave.operators.whatif import (
    DEFAULT_SCENARIOS,
    DEMAND_SPIKES,
    Scenario,
    apply_scenario,
    apply_scenarios,
    demand_spike,
)
from fareweave.plans.prepare import BASE_FEATURES
from fareweave.schema import categorical_columns
from fareweave.sources.files import append_drift_history
from fareweave.storage import materialize

BASELINE = "_baseline"


class DriftDetector:
    """Reports the drift of current tables against one baseline."""

    def __init__(
        self,
        reference: DataFrame,
        options: DriftOptions = DriftOptions(),
        include_target: bool = False,
        target: str = config.TARGET,
    ):
        self.reference = reference
        self.options = options
        self.skip = [*config.ID_COLUMNS, *([] if include_target else [target])]
        self.current: DataFrame | None = None

    def set_current_data(self, current: DataFrame) -> DriftDetector:
        self.current = current
        return self

    def scores(self) -> DataFrame:
        """One row per column."""
        if self.current is None:
            raise ValueError("call set_current_data() first")
        names = drift_columns(self.reference, self.current, self.skip)
        return drift_report(self.reference, self.current, names, self.options)

    def generate_report(self, run_time: str, history: str | None = None, run_id: str | None = None) -> DataFrame:
        """The one-row summary; it joins the history table if a path is given, under the run's id or time."""
        summary = stamp(summarize(self.scores(), self.options), run_time)
        if history:
            summary = materialize(summary, "drift-summary")
            append_drift_history(summary, history, run_id)
        return summary


def encode_weather(df: DataFrame) -> DataFrame:
    """Weather indicators for the fixed categories, in place of the category."""
    return df.withColumns(
        {
            f"weather_condition_{v}": F.when(F.col("weather_condition") == v, 1.0).otherwise(0.0)
            for v in sorted(WEATHER_SEVERITY)
        }
    ).drop("weather_condition")


def drift_features(include_target: bool = False) -> list[str]:
    """The monitored columns of a feature table, in order."""
    weather = [f"weather_condition_{v}" for v in sorted(WEATHER_SEVERITY)]
    target = [config.TARGET] if include_target else []
    return [
        *BASE_FEATURES,
        *weather,
        *target,
        "demand_supply_ratio",
        "hour_sin",
        "hour_cos",
        "demand_weather_interaction",
        "fare_per_driver",
        "is_rush_hour",
        "weather_severity_score",
        "is_night",
    ]


def validate_scenario(scenario: Scenario) -> str | None:
    """Why a scenario cannot be applied, or None."""
    for name in ("demand_factor", "driver_factor"):
        value = getattr(scenario, name)
        if value is not None and not value >= 0:
            return f"{name} must not be negative"
    if scenario.weather is not None and scenario.weather not in WEATHER_SEVERITY:
        return f"unknown weather {scenario.weather!r}"
    return None


def scenario_counts(
    baseline: DataFrame, scenarios: DataFrame, columns: list[str], names: list[str]
) -> DataFrame:
    """Counts per (scenario, feature, value) against the baseline, which is counted once.

    ``scenarios`` holds the variants under their ``scenario`` names.
    """
    text = [c for c in columns if c in categorical_columns(baseline)]
    numeric = [c for c in columns if c not in text]

    def counted(df: DataFrame) -> DataFrame:
        tagged = df.select("scenario", *columns)
        ready = finite_columns(tagged, ["scenario", *columns])
        return value_counts(ready, [*numeric, ROWS], text, ["scenario"])

    base = baseline.select(F.lit(BASELINE).alias("scenario"), *columns)
    raw = materialize(
        counted(base.unionByName(scenarios.select("scenario", *columns))), "scenario-counts"
    )
    return pair_with_baseline(raw, names)


def pair_with_baseline(raw: DataFrame, names: list[str]) -> DataFrame:
    """Put the baseline's counts next to those of every scenario."""
    every = F.explode(F.array(*[F.lit(n) for n in names]))
    none = F.lit(0).cast("long")
    value = ["feature", "x", "v"]
    ref = raw.where(F.col("scenario") == BASELINE).select(
        every.alias("scenario"), *value, F.col("n").alias("n_ref"), none.alias("n_cur")
    )
    cur = raw.where(F.col("scenario") != BASELINE).select(
        "scenario", *value, none.alias("n_ref"), F.col("n").alias("n_cur")
    )
    paired = (
        ref.unionByName(cur)
        .groupBy("scenario", *value)
        .agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    )
    return materialize(paired, "scenario-pairs")


def compare_scenarios(
    rides: DataFrame,
    scenarios: list[Scenario] | None = None,
    options: DriftOptions = DriftOptions(),
    samples: dict[str, tuple[int, int]] | None = None,
    key: str = "ride_id",
    include_target: bool = False,
) -> DataFrame:
    """Drift of each scenario against the rides it was made from, one row per feature.

    Without ``samples`` every scenario covers the whole table and all of them, the
    unchanged baseline included, come from one scan. With it a scenario covers an
    exact sample of (rows, seed).
    """
    scenarios = DEFAULT_SCENARIOS if scenarios is None else scenarios
    usable = [s for s in scenarios if validate_scenario(s) is None]
    columns = drift_features(include_target)
    raw_columns = [key, *BASE_FEATURES, "weather_condition", *([config.TARGET] if include_target else [])]
    rides = rides.select(*raw_columns)
    names = [s.name for s in usable]
    if samples is None:
        variants = encode_weather(apply_scenarios(rides, [Scenario(BASELINE), *usable]))
        ready = finite_columns(variants, ["scenario", *columns])
        raw = materialize(value_counts(ready, [*columns, ROWS], [], ["scenario"]), "scenario-counts")
        counts = pair_with_baseline(raw, names)
    else:
        drawn = {
            plan: materialize(exact_sample(rides, key, *plan), "sample")
            for plan in sorted({samples[n] for n in names})
        }
        parts = [
            apply_scenarios(drawn[plan], [s for s in usable if samples[s.name] == plan]) for plan in drawn
        ]
        current = parts[0]
        for part in parts[1:]:
            current = current.unionByName(part)
        base = encode_weather(apply_scenario(rides, Scenario(BASELINE)))
        counts = scenario_counts(base, encode_weather(current), columns, names)
    return score_counts(counts, columns, options, ["scenario"])


def run_simulation(
    rides: DataFrame,
    scenarios: list[Scenario | str] | None = None,
    options: DriftOptions = DriftOptions(),
    samples: dict[str, tuple[int, int]] | None = None,
    key: str = "ride_id",
) -> DataFrame:
    """Summary per scenario. One that cannot be applied gets a row with its error.

    A string names a demand spike severity.
    """
    good: list[Scenario] = []
    bad: list[tuple[str, str]] = []
    for entry in DEFAULT_SCENARIOS if scenarios is None else scenarios:
        try:
            scenario = demand_spike(entry) if isinstance(entry, str) else entry
        except ValueError as error:
            bad.append((entry, str(error)))
            continue
        problem = validate_scenario(scenario)
        if problem:
            bad.append((scenario.name, problem))
        else:
            good.append(scenario)
    spark = rides.sparkSession
    failed = spark.createDataFrame(
        bad,
        T.StructType([T.StructField("scenario", T.StringType()), T.StructField("error", T.StringType())]),
    )
    if not good:
        return failed
    if samples is not None:
        report = compare_scenarios(rides, good, options, samples, key)
        return summarize(report, options, ["scenario"]).unionByName(failed, allowMissingColumns=True)
    counts, errors = _isolated_counts(rides, good, key)
    failed = failed.unionByName(spark.createDataFrame(errors, failed.schema))
    if counts is None:
        return failed
    report = score_counts(counts, drift_features(), options, ["scenario"])
    return summarize(report, options, ["scenario"]).unionByName(failed, allowMissingColumns=True)


def _isolated_counts(
    rides: DataFrame, scenarios: list[Scenario], key: str
) -> tuple[DataFrame | None, list[tuple[str, str]]]:
    """Counts of the scenarios whose rows could be computed, paired with the baseline's; and the others' errors.

    Scenarios of plain rules share one scan. One with expressions of its own has a job of its
    own, under the tag ``scenario-<name>``; so has every one if the shared scan fails. The
    baseline is counted once; if that fails, so does the call.
    """
    spark = rides.sparkSession
    rides = rides.select(key, *BASE_FEATURES, "weather_condition")
    columns = drift_features()

    def counted(variants: DataFrame) -> DataFrame:
        ready = finite_columns(encode_weather(variants), ["scenario", *columns])
        return materialize(value_counts(ready, [*columns, ROWS], [], ["scenario"]), "scenario-counts")

    def alone(scenario: Scenario) -> DataFrame:
        tag = "scenario-" + re.sub(r"\W", "_", scenario.name)
        spark.addTag(tag)
        try:
            return counted(apply_scenario(rides, scenario).withColumn("scenario", F.lit(scenario.name)))
        finally:
            spark.removeTag(tag)

    shared = [s for s in scenarios if not s.changes]
    done, errors = [], []
    try:
        base = counted(apply_scenarios(rides, [Scenario(BASELINE), *shared]))
        done += [s.name for s in shared]
        left = [s for s in scenarios if s.changes]
    except PySparkException:
        base, left = alone(Scenario(BASELINE)), scenarios
    for scenario in left:
        try:
            base = base.unionByName(alone(scenario))
            done.append(scenario.name)
        except PySparkException as error:
            errors.append((scenario.name, str(error).splitlines()[0]))
    return (pair_with_baseline(base, done) if done else None), errors


__all__ = [
    "BASELINE",
    "DEMAND_SPIKES",
    "DriftDetector",
    "compare_scenarios",
    "drift_features",
    "encode_weather",
    "run_simulation",
    "scenario_counts",
]
