"""One-hot encoding of columns with any number of categories: positions instead of columns.

The categories stay a table. Each gets its place in the sorted order of its column, found by ranges
of the sorted table, so neither the driver nor one task holds them; rows find their places
by joining the value.
"""

from __future__ import annotations

from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fareweave.operators.counts import PART
from fareweave.operators.encode import category_table
from fareweave.storage import materialize

POSITIONS, SIZE = "positions", "size"


def category_places(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, category, place): places count from 0 in the order of ``columns`` and then of the sorted categories.

    The table is written once; it is the fitted state of the encoding. NULL is no category.
    """
    order = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column_name"))
    listed = category_table(df.select(*[F.col(c).cast("string").alias(c) for c in columns]), columns)
    ranged = listed.withColumn("_order", order).repartitionByRange("_order", "category")
    stored = materialize(ranged.withColumn(PART, F.spark_partition_id()), "categories")
    # One row for each range and column that it holds.
    sizes = stored.groupBy("_order", PART).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(F.lit(0)).orderBy("_order", PART).rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = F.row_number().over(W.partitionBy("_order", PART).orderBy("category"))
    placed = stored.join(starts, ["_order", PART]).withColumn("place", F.col("_start") + inside - 1)
    return materialize(placed.select("column_name", "category", "place"), "category-places")


def sparse_one_hot(df: DataFrame, columns: list[str], places: DataFrame) -> DataFrame:
    """The rows with ``size``, the number of places, and ``positions``, the sorted places that are 1; without ``columns``.

    A value that is NULL or was not there when the places were given has no position.
    """
    size = places.agg(F.count(F.lit(1))).first()[0]
    found = []
    for i, c in enumerate(columns):
        mine = places.where(F.col("column_name") == c).select(F.col("category").alias("_category"), F.col("place").alias(f"_p{i}"))
        df = df.join(mine, F.col(c).cast("string") == F.col("_category"), "left").drop("_category")
        found.append(f"_p{i}")
    positions = F.sort_array(F.array_compact(F.array(*found)))
    return df.withColumns({POSITIONS: positions, SIZE: F.lit(size).cast("long")}).drop(*columns, *found)


@F.udf(VectorUDT())
def _vector(size, positions):
    return Vectors.sparse(size, positions, [1.0] * len(positions))


def as_vectors(df: DataFrame, name: str = "features") -> DataFrame:
    """``size`` and ``positions`` as a sparse vector, for learners of Spark ML."""
    return df.withColumn(name, _vector(SIZE, POSITIONS)).drop(SIZE, POSITIONS)
