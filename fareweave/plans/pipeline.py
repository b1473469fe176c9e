"""The whole batch pipeline: rides in; tables, models and records out."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareweave.operators.features import add_features
from fareweave.plans.monitoring import DriftDetector, encode_weather
from fareweave.plans.predictor import PricePredictor
from fareweave.plans.prepare import Prepared, prepare
from fareweave.plans.training import Trained, run_log, train_all
from fareweave.sources.files import RUN, read_baseline, read_runs, write_best_metrics, write_run, write_table
from fareweave.storage import scratch_scope


@dataclass(frozen=True)
class Paths:
    """Where a run writes below one output folder."""

    root: str

    def of(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def write_processed(prepared: Prepared, paths: Paths) -> None:
    """The model-ready table, both splits, partitioned by split."""
    write_table(prepared.table, paths.of("processed"), partition_by=["split"])


def write_baseline(prepared: Prepared, paths: Paths) -> None:
    """Unscaled features of the training rows: what later data is compared with."""
    train = prepared.rides.where("split = 'train'").drop("split", "timestamp")
    filled = prepared.state.imputer.transform(train)
    write_table(encode_weather(add_features(filled)), paths.of("baseline"))


def run_pipeline(
    rides: DataFrame,
    out: str,
    experiments: list[dict] | None = None,
    exact_split: bool = False,
    run_id: str | None = None,
) -> Trained:
    """Prepare, train and compare all experiments, and write every result below ``out``.

    ``run_log`` and ``runs`` keep the log and the comparison of every run, one partition per id;
    a run that is repeated under its id replaces what it wrote. Without an id each call is a run
    of its own. The other tables hold the last run. Intermediate tables are deleted at the end.
    """
    with scratch_scope(rides.sparkSession):
        return _run_pipeline(rides, Paths(out), experiments, exact_split, run_id or uuid.uuid4().hex)


def _run_pipeline(
    rides: DataFrame, paths: Paths, experiments: list[dict] | None, exact_split: bool, run_id: str
) -> Trained:
    spark = rides.sparkSession
    prepared = prepare(rides, exact=exact_split)
    write_processed(prepared, paths)
    write_baseline(prepared, paths)
    trained = train_all(prepared, experiments)
    write_table(trained.comparison, paths.of("model_comparison"), "csv")
    write_run(run_log(trained), paths.of("run_log"), run_id)
    write_run(trained.comparison, paths.of("runs"), run_id)
    write_best_metrics(trained.best(), paths.of("metrics"))
    record = trained.best().first().asDict()
    metrics = {k: v for k, v in record.items() if k != "best_model"}
    best = PricePredictor.of(trained.best_run(), prepared.state, metrics)
    best.save(spark, paths.of("predictor"))
    write_run(trained.metrics, paths.of("split_metrics"), run_id)

    def mine(table: str) -> DataFrame:
        return read_runs(spark, paths.of(table)).where(F.col(RUN) == run_id).drop(RUN)

    # What stays readable after the scratch tables are gone.
    return Trained(trained.runs, mine("split_metrics"), mine("runs").orderBy("test_rmse", "model_name"))


def load_predictor(spark: SparkSession, out: str) -> PricePredictor:
    return PricePredictor.load(spark, Paths(out).of("predictor"))


def check_drift(
    spark: SparkSession, rides: DataFrame, out: str, run_time: str, run_id: str | None = None
) -> DataFrame:
    """Compare rides with the baseline of a run and add the summary to its drift history."""
    baseline = read_baseline(spark, Paths(out).of("baseline"))
    current = encode_weather(add_features(rides))
    detector = DriftDetector(baseline).set_current_data(current)
    return detector.generate_report(run_time, Paths(out).of("drift_history"), run_id)


__all__ = ["check_drift", "load_predictor", "run_pipeline"]
