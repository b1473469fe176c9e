"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*", name: str = "fareweave", options: dict[str, str] | None = None
) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        # The JVM does not compile larger methods; Spark then takes its other path.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        # One small file is read by all cores; a large table has more splits than cores anyway.
        .config("spark.sql.files.maxPartitionBytes", "16m")
        .config("spark.sql.files.openCostInBytes", "256k")
        .config(map=options or {})
        .getOrCreate()
    )
