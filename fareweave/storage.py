"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Tables that ``materialize`` has written, in order.
_STORED: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``. In local mode, where it may be unset, a folder below the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not (spark.sparkContext.master + "[").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def scratch_home(spark: SparkSession) -> str:
    """What this application keeps below the shared folder."""
    return f"{scratch_root(spark).rstrip('/')}/fareweave/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_home(spark)}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system it belongs to."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """What is stored within is deleted at the end; results must have been read or written elsewhere by then."""
    before = len(_STORED)
    try:
        yield
    finally:
        for path in _STORED[before:]:
            delete_path(spark, path)
        del _STORED[before:]


def keep_checkpoints(spark: SparkSession) -> None:
    """Give learners that cut their lineage a folder for it, unless the session has one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_path(spark, "checkpoints"))


def clear_scratch(spark: SparkSession) -> None:
    """Delete all that this application keeps below the shared folder, when nothing reads it any more."""
    delete_path(spark, scratch_home(spark))


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over the session's shuffle partitions, and over all cores at least."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def materialize(df: DataFrame, name: str, evenly: bool = False) -> DataFrame:
    """Write a table once and read it back.

    Readers do not recompute the lineage when an executor is lost, prune columns,
    and see a true size in the plan, by which Spark chooses its joins. With ``evenly``
    the rows are dealt out before they are written: a small table that many passes read
    then lies in as many files as there are cores, not in one that cannot be split.
    """
    path = scratch_path(df.sparkSession, name)
    _STORED.append(path)
    (spread(df) if evenly else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
