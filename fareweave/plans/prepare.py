"""From rides to a model-ready table: split, clean, engineer, encode, scale."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareweave import config
from fareweave.functions.numeric import present
from fareweave.operators.clean import Imputer, drop_columns, fit_imputer_and_counts
from fareweave.operators.encode import OneHotEncoder, StandardScaler, fit_scaler, one_hot_of
from fareweave.operators.features import ENGINEERED, add_features
from fareweave.operators.split import exact_split, hash_split

BASE_FEATURES = [
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "passenger_demand",
    "driver_availability",
    "temperature",
    "visibility_km",
    "base_fare",
]

STATE = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("text", T.StringType()),
        T.StructField("number", T.DoubleType()),
        T.StructField("number2", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class FittedState:
    """Everything learnt from the training rows before the model."""

    imputer: Imputer
    encoder: OneHotEncoder
    scaler: StandardScaler
    features: tuple[str, ...]

    def engineer(self, df: DataFrame) -> DataFrame:
        """Raw rides or requests to unscaled features. Adds columns, keeps the raw ones."""
        filled = add_features(self.imputer.transform(df))
        return filled.withColumns(self.encoder.indicators())

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Scaled features in training order, after the ``keep`` columns."""
        engineered = self.engineer(df)
        kept = [F.col(c).alias(f"_keep_{c}") for c in keep or []]
        scaled = self.scaler.transform(engineered.select(*kept, *self.features))
        return scaled.select(
            *[F.col(f"_keep_{c}").alias(c) for c in keep or [] if c not in self.features],
            *self.features,
        )

    def to_table(self, spark: SparkSession) -> DataFrame:
        gaps = self.imputer.gaps
        rows = [("median", c, None, None, v, float(c in gaps)) for c, v in self.imputer.medians.items()]
        rows += [
            ("mode", c, None, str(v), float(isinstance(v, bool)), None) for c, v in self.imputer.modes.items()
        ]
        rows += [
            ("category", c, i, v, None, None)
            for c, values in self.encoder.categories.items()
            for i, v in enumerate(values)
        ]
        rows += [("scale", c, None, None, m, self.scaler.stds[c]) for c, m in self.scaler.means.items()]
        rows += [("feature", c, i, None, None, None) for i, c in enumerate(self.features)]
        return spark.createDataFrame(rows, STATE)

    def save(self, spark: SparkSession, path: str) -> None:
        self.to_table(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> FittedState:
        """Read a saved state: one row per column and category."""
        rows = spark.read.schema(STATE).parquet(path).collect()

        def of(kind: str) -> list:
            picked = [r for r in rows if r["kind"] == kind]
            return sorted(picked, key=lambda r: (r["position"] or 0))

        categories: dict[str, list[str]] = {}
        for r in of("category"):
            categories.setdefault(r["column_name"], []).append(r["text"])
        return FittedState(
            Imputer(
                {r["column_name"]: r["number"] for r in of("median")},
                {r["column_name"]: r["text"] == "True" if r["number"] else r["text"] for r in of("mode")},
                tuple(r["column_name"] for r in of("median") if r["number2"]),
            ),
            OneHotEncoder({c: tuple(v) for c, v in categories.items()}),
            StandardScaler(
                {r["column_name"]: r["number"] for r in of("scale")},
                {r["column_name"]: r["number2"] for r in of("scale")},
            ),
            tuple(r["column_name"] for r in of("feature")),
        )


@dataclass(frozen=True)
class Prepared:
    """A table with ``split``, the target and the scaled features, and its fitted state.

    ``rides`` are the labelled raw rows with the same ``split``.
    """

    table: DataFrame
    state: FittedState
    rides: DataFrame

    def part(self, split: str) -> DataFrame:
        return self.table.where(F.col("split") == split)


def with_split(rides: DataFrame, key: str, test_share: float, seed: int, exact: bool) -> DataFrame:
    make = exact_split if exact else hash_split
    return make(rides, key, test_share, seed)


def feature_names(encoder: OneHotEncoder) -> list[str]:
    return [*BASE_FEATURES, *encoder.names(), *ENGINEERED]


def fit_state(
    rides: DataFrame,
    target: str = config.TARGET,
    categorical: list[str] | None = None,
    max_categories: int = 100,
    approx: bool = False,
) -> FittedState:
    """Learn fill values, categories and scaling from the given rows; never from the target.

    With ``approx``, medians come from sketches instead of exact ranks.
    """
    categorical = categorical or config.CATEGORICAL_COLUMNS
    raw = rides.select(*BASE_FEATURES, *categorical)
    # One scan counts the values of all columns: fill values and categories come from the counts. A fill value is a category.
    imputer, counts = fit_imputer_and_counts(raw, approx=approx)
    listed = counts.where(F.col("feature").isin(categorical) & F.col("v").isNotNull())
    encoder = one_hot_of(
        listed.select(F.col("feature").alias("column_name"), F.col("v").alias("category")), categorical, max_categories
    )
    names = feature_names(encoder)
    unscaled = FittedState(imputer, encoder, StandardScaler({}, {}), tuple(names))
    scaler = fit_scaler(unscaled.engineer(raw).select(*names), names)
    return FittedState(imputer, encoder, scaler, tuple(names))


def prepare(
    rides: DataFrame,
    key: str = "ride_id",
    target: str = config.TARGET,
    test_share: float = config.TEST_SHARE,
    seed: int = config.SEED,
    exact: bool = False,
    fit_on: str = "train",
    approx: bool = False,
) -> Prepared:
    """Split, fit on the training rows (or on all) and transform both splits.

    Rows without a target are dropped. Features are engineered on raw values and
    scaled afterwards.
    """
    labelled = rides.where(present(F.col(target)))
    split = with_split(labelled, key, test_share, seed, exact)
    learn = split if fit_on == "all" else split.where(F.col("split") == "train")
    state = fit_state(drop_columns(learn, config.ID_COLUMNS), target, approx=approx)
    table = state.transform(split, keep=[key, "split", target])
    return Prepared(table, state, split)
