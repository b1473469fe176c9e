"""Batch scoring: validation, the shared preprocessing, prediction, price and confidence."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareweave.functions import rides as R
from fareweave.functions.numeric import round_half_even
from fareweave.operators.features import add_features
from fareweave.operators.quality import split_requests

RAW = "prediction"

# A scorer adds a raw ``prediction`` column to request rows.
Scorer = Callable[[DataFrame], DataFrame]


def formula_scorer(df: DataFrame) -> DataFrame:
    """The price formula as a model."""
    priced = R.formula_multiplier(
        F.col("demand_supply_ratio"),
        F.col("weather_severity_score"),
        F.col("is_rush_hour"),
        F.col("is_weekend"),
    )
    return df.transform(add_features).withColumn(RAW, priced)


def finish_prediction(df: DataFrame, raw: str = RAW, decimals: int | None = 2) -> DataFrame:
    """Clip the raw prediction and add multiplier, price and confidence.

    The price and the label come from the unrounded multiplier; ``decimals=None``
    leaves the two numbers unrounded.
    """
    p = R.clip_multiplier(F.col(raw))
    price = F.col("base_fare") * p

    def shown(c):
        return c if decimals is None else round_half_even(c, decimals)

    return df.withColumns(
        {
            "price_multiplier": shown(p),
            "estimated_price": shown(price),
            "confidence": R.confidence(p),
        }
    )


def score_requests(
    df: DataFrame, scorer: Scorer, decimals: int | None = 2
) -> tuple[DataFrame, DataFrame]:
    """Score valid requests and set invalid ones aside with their errors.

    The scored table has the input columns plus multiplier, price and confidence.
    """
    accepted, rejected = split_requests(df)
    scored = finish_prediction(scorer(accepted), decimals=decimals)
    return (
        scored.select(*accepted.columns, "price_multiplier", "estimated_price", "confidence"),
        rejected,
    )
