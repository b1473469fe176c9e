"""A saved model with its fitted state, ready to score batches and streams."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareweave.operators.score import RAW, score_requests
from fareweave.plans.prepare import FittedState
from fareweave.plans.saved_pipeline import ROW, RidePreparation, state_to_json
from fareweave.plans.training import Run

CARD = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("model_type", T.StringType()),
        T.StructField("features", T.ArrayType(T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    ]
)


@dataclass(frozen=True)
class PricePredictor:
    """Scores requests with the preprocessing the model was trained with."""

    name: str
    kind: str
    model: PipelineModel
    state: FittedState
    metrics: dict[str, float]

    @staticmethod
    def of(run: Run, state: FittedState, metrics: dict[str, float] | None = None) -> PricePredictor:
        return PricePredictor(run.name, run.kind, run.model, state, metrics or {})

    def preprocess(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Scaled features in training order, whatever the model type."""
        return self.state.transform(df, keep)

    def scorer(self, df: DataFrame) -> DataFrame:
        """Add the raw prediction to request rows.

        The row travels along in one struct column, because scaling changes columns
        that the price needs unscaled.
        """
        scored = self.pipeline().transform(df)
        return scored.select(f"{ROW}.*", F.col(f"prediction_{self.name}").alias(RAW))

    def pipeline(self) -> PipelineModel:
        """Preparation and model as one pipeline, which is also what is saved."""
        card = json.dumps({"name": self.name, "kind": self.kind, "metrics": self.metrics})
        return PipelineModel([RidePreparation(state=state_to_json(self.state), card=card), *self.model.stages])

    def predict(self, df: DataFrame, decimals: int | None = 2) -> tuple[DataFrame, DataFrame]:
        """Scored valid requests and quarantined invalid ones."""
        return score_requests(df, self.scorer, decimals)

    def card(self, spark: SparkSession) -> DataFrame:
        """One row: model name, type, features and metrics."""
        row = (self.name, self.kind, list(self.state.features), self.metrics)
        return spark.createDataFrame([row], CARD)

    def save(self, spark: SparkSession, path: str) -> None:
        """One saved pipeline: the state and the card are parameters of its first stage."""
        self.pipeline().write().overwrite().save(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> PricePredictor:
        preparation, *stages = PipelineModel.load(path).stages
        told = preparation.told()
        return PricePredictor(told["name"], told["kind"], PipelineModel(stages), preparation.fitted(), told["metrics"])
