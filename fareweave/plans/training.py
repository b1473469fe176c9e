"""Training, comparing and selecting Spark ML regressors."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareweave import config
from fareweave.operators.evaluate import best_model, compare_models, evaluate_models, metric_log
from fareweave.plans.boosting import STORE_EVERY, HistogramBoosting, TreeSettings
from fareweave.plans.forest import ForestSettings, HistogramForest
from fareweave.plans.prepare import Prepared
from fareweave.storage import keep_checkpoints, materialize

VECTOR = "_features"
# Memory for the histograms of a pass over the rows, in each task, and for the places of its rows: trees beyond it are
# grown in further passes, nodes beyond it counted one part after the other; the trees are the same.
TREE_MEMORY_MB = 96


def _linear(params: dict, train: DataFrame, target: str) -> LinearRegression:
    # Indicators that add up to one make the sums singular; they are then minimised on the driver, to the last digits.
    return LinearRegression(regParam=0.0, solver="normal", tol=1e-14, maxIter=1000)


def _ridge(params: dict, train: DataFrame, target: str) -> LinearRegression:
    """Ridge with penalty ``alpha`` on the sum of squared errors, intercept unpenalised.

    Spark minimises the mean squared error of a label divided by its standard
    deviation, hence the factor.
    """
    size = train.agg(F.count(target).alias("n"), F.stddev_pop(target).alias("s")).first()
    strength = params.get("alpha", 1.0) * size["s"] / size["n"] if size["n"] else 0.0
    return LinearRegression(
        regParam=strength, elasticNetParam=0.0, standardization=False, solver="normal"
    )


def _forest(params: dict, train: DataFrame, target: str) -> HistogramForest:
    """Spark ML's rules: Poisson draws of the rows, all features at every node, a leaf of the least size at least."""
    settings = ForestSettings(
        trees=params.get("trees", 100),
        max_depth=params.get("max_depth", 12),
        min_leaf=params.get("min_leaf", 5),
        bootstrap=params.get("bootstrap", True),
        bins=params.get("bins", 32),
        memory_mb=params.get("memory_mb", TREE_MEMORY_MB),
        seed=params.get("seed", config.SEED),
    )
    return HistogramForest(settings=settings)


def _boosted(params: dict, train: DataFrame, target: str) -> HistogramBoosting:
    """Spark ML's rules: the first tree fits the target, later ones twice the residuals; features are drawn for each node; every split that gains is kept."""
    settings = TreeSettings(
        rounds=params.get("rounds", 150),
        max_depth=params.get("max_depth", 6),
        learning_rate=params.get("learning_rate", 0.1),
        row_share=params.get("row_share", 0.8),
        column_share=params.get("column_share", 0.8),
        bins=params.get("bins", 32),
        seed=params.get("seed", config.SEED),
        store_every=params.get("checkpoint_every", STORE_EVERY),
        leaves=None,
        min_leaf=1,
        by_node=True,
        first_whole=True,
        slope=2.0,
        refuse_gaps=True,
    )
    return HistogramBoosting(settings=settings)


def _boosted_fine(params: dict, train: DataFrame, target: str) -> HistogramBoosting:
    """The second boosted configuration: finer histograms of the features."""
    return _boosted({"bins": 255, **params}, train, target)


def _histogram(defaults: dict) -> Callable[[dict, DataFrame, str], HistogramBoosting]:
    def make(params: dict, train: DataFrame, target: str) -> HistogramBoosting:
        return HistogramBoosting(settings=TreeSettings(**{**defaults, **params}))

    return make


# Learner kinds by name; a caller may add to it.
LEARNERS = {
    "LinearRegression": _linear,
    "Ridge": _ridge,
    "RandomForest": _forest,
    "GradientBoosting": _boosted,
    "GradientBoostingFineBins": _boosted_fine,
    # Trees of at most 31 leaves, the best leaf split first.
    "LeafwiseBoosting": _histogram({"leaves": 31, "min_leaf": 20, "l2": 0.0}),
    # Every leaf split that gains, down to the depth.
    "LevelwiseBoosting": _histogram({"leaves": None, "min_leaf": 1, "l2": 1.0}),
}


@dataclass(frozen=True)
class Run:
    """One trained model with what was measured while training it."""

    name: str
    kind: str
    params: dict
    model: PipelineModel
    features: tuple[str, ...]
    seconds: float


def train_model(
    name: str,
    kind: str,
    params: dict,
    train: DataFrame,
    features: list[str],
    target: str = config.TARGET,
) -> Run:
    """Fit one learner on the training rows; ``prediction_<name>`` is its output column."""
    keep_checkpoints(train.sparkSession)
    learner = LEARNERS[kind](params, train, target)
    learner = learner.setFeaturesCol(VECTOR).setLabelCol(target).setPredictionCol(f"prediction_{name}")
    assembler = VectorAssembler(inputCols=list(features), outputCol=VECTOR)
    started = time.perf_counter()
    model = Pipeline(stages=[assembler, learner]).fit(train)
    return Run(name, kind, params, model, tuple(features), time.perf_counter() - started)


def predict_with(run: Run, df: DataFrame) -> DataFrame:
    return run.model.transform(df).drop(VECTOR)


def predictions(runs: list[Run], table: DataFrame) -> DataFrame:
    """The table with one prediction column per model, in one pass."""
    for run in runs:
        table = predict_with(run, table)
    return table


def runs_table(spark: SparkSession, runs: list[Run]) -> DataFrame:
    schema = "model_name string, model_class string, training_time_s double"
    return spark.createDataFrame([(r.name, r.kind, r.seconds) for r in runs], schema)


@dataclass(frozen=True)
class Trained:
    """All runs with their metrics per split and the comparison, best first."""

    runs: list[Run]
    metrics: DataFrame
    comparison: DataFrame

    def best(self) -> DataFrame:
        return best_model(self.comparison)

    def best_run(self) -> Run:
        name = self.best().first()["best_model"]
        return next(r for r in self.runs if r.name == name)


def train_all(
    prepared: Prepared, experiments: list[dict] | None = None, target: str = config.TARGET
) -> Trained:
    """Train every experiment on the same written table and compare them.

    The prepared table is written once: five learners read it many times, and it may
    be larger than the cluster's memory.
    """
    table = materialize(prepared.table, "prepared", evenly=True)
    return train_table(table, list(prepared.state.features), experiments, target)


def train_table(
    table: DataFrame, features: list[str], experiments: list[dict] | None = None, target: str = config.TARGET
) -> Trained:
    """Train every experiment on the ``train`` rows of a stored table and compare them on both splits."""
    experiments = config.EXPERIMENTS if experiments is None else experiments
    train = table.where(F.col("split") == "train")
    runs = [
        train_model(e["name"], e["kind"], e["params"], train, features, target) for e in experiments
    ]
    spark = table.sparkSession
    scored = predictions(runs, table)
    columns = {r.name: f"prediction_{r.name}" for r in runs}
    metrics = materialize(evaluate_models(scored, target, columns), "metrics")
    return Trained(runs, metrics, compare_models(metrics, runs_table(spark, runs)))


def run_log(trained: Trained) -> DataFrame:
    """Parameters, metrics and training time per run: (model_name, kind, key, value)."""
    spark = trained.metrics.sparkSession
    rows = []
    for r in trained.runs:
        rows.append((r.name, "param", "model_class", r.kind))
        rows += [(r.name, "param", k, str(v)) for k, v in r.params.items()]
        rows.append((r.name, "metric", "training_time", str(r.seconds)))
    schema = T.StructType(
        [T.StructField(n, T.StringType()) for n in ("model_name", "kind", "key", "value")]
    )
    measured = metric_log(trained.metrics).select(
        "model_name", F.lit("metric").alias("kind"), "key", F.col("value").cast("string").alias("value")
    )
    return spark.createDataFrame(rows, schema).unionByName(measured)


def importances(run: Run) -> dict[str, float] | None:
    """Feature importances of a tree model."""
    model: Model = run.model.stages[-1]
    if not hasattr(model, "featureImportances"):
        return None
    return dict(zip(run.features, model.featureImportances.toArray().tolist()))
