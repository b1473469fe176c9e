"""Regression metrics, model comparison and selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def metric_columns(y: Column, p: Column) -> list[Column]:
    """RMSE, MAE and R² as aggregates; R² of a constant target is 1 for a perfect fit, else 0."""
    error = y - p
    sse = F.sum(error * error)
    # Rows without a prediction count on neither side.
    sst = F.var_pop(F.when(error.isNotNull(), y)) * F.count(error)
    r2 = F.when(sst > 0, F.lit(1.0) - sse / sst).when(sse == 0, 1.0).when(sse > 0, 0.0)
    return [
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        r2.alias("r2"),
    ]


def evaluate(df: DataFrame, label: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """Metrics of one prediction column, over all rows or per group."""
    return df.groupBy(*(by or [])).agg(*metric_columns(F.col(label), F.col(prediction)))


def evaluate_models(
    df: DataFrame, label: str, predictions: dict[str, str], split: str = "split"
) -> DataFrame:
    """Metrics per model and split. All models are evaluated in one pass over the rows."""
    long = df.select(
        split, F.col(label).alias("_y"), *[F.col(c).alias(m) for m, c in predictions.items()]
    ).unpivot([split, "_y"], list(predictions), "model_name", "_p")
    return evaluate(long, "_y", "_p", ["model_name", split])


def compare_models(metrics: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """One row per model with train and test metrics, best test RMSE first.

    ``runs`` may add ``model_class`` and ``training_time_s`` per model.
    """

    def of(split: str, metric: str) -> Column:
        return F.max(F.when(F.col("split") == split, F.col(metric))).alias(f"{split}_{metric}")

    table = metrics.groupBy("model_name").agg(
        of("train", "rmse"), of("train", "r2"), of("test", "rmse"), of("test", "r2"), of("test", "mae")
    )
    if runs is not None:
        table = table.join(runs, "model_name", "left").select(
            "model_name",
            "model_class",
            "train_rmse",
            "train_r2",
            "test_rmse",
            "test_r2",
            "test_mae",
            "training_time_s",
        )
    return table.orderBy("test_rmse", "model_name")


def best_model(comparison: DataFrame) -> DataFrame:
    """The record of the model with the smallest test RMSE; ties go to the smaller name."""
    time = F.col("training_time_s") if "training_time_s" in comparison.columns else F.lit(None)
    return (
        comparison.orderBy("test_rmse", "model_name")
        .limit(1)
        .select(
            F.col("model_name").alias("best_model"),
            "test_rmse",
            "test_r2",
            "test_mae",
            time.cast("double").alias("training_time"),
        )
    )


def metric_log(metrics: DataFrame) -> DataFrame:
    """Metrics in long form: (model_name, key, value) with keys such as ``train_rmse``."""
    return metrics.unpivot(["model_name", "split"], ["rmse", "mae", "r2"], "metric", "value").select(
        "model_name", F.concat_ws("_", "split", "metric").alias("key"), "value"
    )
