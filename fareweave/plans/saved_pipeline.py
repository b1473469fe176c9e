"""Preparation and model in one saved pipeline."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareweave.operators.clean import Imputer
from fareweave.operators.encode import OneHotEncoder, StandardScaler
from fareweave.plans.prepare import FittedState

ROW = "_row"


def state_to_json(state: FittedState) -> str:
    """All that was learnt, as one JSON document; numbers come back to the last digit."""
    return json.dumps(asdict(state), sort_keys=True)


def state_from_json(text: str) -> FittedState:
    told = json.loads(text)
    imputer = {**told["imputer"], "gaps": tuple(told["imputer"]["gaps"]), "empty": tuple(told["imputer"]["empty"])}
    return FittedState(
        Imputer(**imputer),
        OneHotEncoder({c: tuple(v) for c, v in told["encoder"]["categories"].items()}),
        StandardScaler(**told["scaler"]),
        tuple(told["features"]),
    )


class RidePreparation(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The first stage of a saved pipeline: requests in, scaled features out, the request itself in ``_row``.

    Its parameters are the fitted state and a card (name, kind, metrics of the model), as JSON.
    """

    state = Param(Params._dummy(), "state", "the fitted state, as JSON", TypeConverters.toString)
    card = Param(Params._dummy(), "card", "name, kind and metrics of the model, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state: str | None = None, card: str = "{}") -> None:
        super().__init__()
        self._set(**{k: v for k, v in {"state": state, "card": card}.items() if v is not None})

    def fitted(self) -> FittedState:
        return state_from_json(self.getOrDefault(self.state))

    def told(self) -> dict:
        return json.loads(self.getOrDefault(self.card))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        packed = dataset.withColumn(ROW, F.struct(*dataset.columns))
        return self.fitted().transform(packed, keep=[ROW])
