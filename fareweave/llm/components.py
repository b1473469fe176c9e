"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareweave.storage import delete_path, scratch_path


def _stored(edges: DataFrame) -> tuple[DataFrame, str, tuple]:
    """The links, written once; where they lie; their number and a checksum."""
    spark = edges.sparkSession
    path = scratch_path(spark, "links")
    edges.write.parquet(path)
    stored = spark.read.schema(edges.schema).parquet(path)
    mark = stored.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low"))).first()
    return stored, path, tuple(mark)


def _with_least(arrows: DataFrame) -> DataFrame:
    """Each (node, other) with the least other of the node.

    The least is counted before the shuffle; the join leaves a hub that holds a large
    part of the rows to adaptive execution, which splits it.
    """
    least = arrows.groupBy("node").agg(F.min("other").alias("least"))
    return arrows.join(least, "node")


def connected_components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """One row (node, component) for each value in ``left`` or ``right``; component is the least value reachable.

    ``links`` holds undirected links between values of one orderable type. Repeated
    links, both directions and links to oneself are allowed; rows with a null end are
    no links. A value that only links to itself is not returned. An empty table gives
    an empty table. Each round (a large star, then a small star) is written to the
    shared folder; the driver sees a count and a checksum. Rounds end when the links
    no longer change, which leaves each node linked to the least of its component.
    """
    high, low = F.greatest(left, right).alias("high"), F.least(left, right).alias("low")
    edges, path, mark = _stored(
        links.where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right)))
        .select(high, low)
        .distinct()
    )
    while True:
        there = edges.select(F.col("high").alias("node"), F.col("low").alias("other"))
        back = edges.select(F.col("low").alias("node"), F.col("high").alias("other"))
        large = (
            _with_least(there.unionByName(back))
            .where(F.col("other") > F.col("node"))
            .select(F.col("other").alias("node"), F.least("node", "least").alias("other"))
            .distinct()
        )
        small = (
            _with_least(large)
            .select(
                F.explode(
                    F.array(
                        F.struct(F.col("node").alias("high"), F.col("least").alias("low")),
                        F.struct(F.col("other").alias("high"), F.col("least").alias("low")),
                    )
                ).alias("e")
            )
            .select("e.high", "e.low")
            .where("high <> low")
            .distinct()
        )
        edges, new_path, new_mark = _stored(small)
        delete_path(edges.sparkSession, path)
        path = new_path
        if new_mark == mark:
            break
        mark = new_mark
    roots = edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(roots)
