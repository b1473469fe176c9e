"""Readers with fixed schemas and writers for tables, documents and fitted state."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareweave.schema import MALFORMED, REQUEST, RIDES, as_text


# CSV keeps microseconds, which the default format would cut.
CSV_OPTIONS = {"header": True, "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}


class MissingTable(FileNotFoundError):
    """A table that a caller needs is not there."""


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Read CSV (with header), JSON, lines of text or Parquet. CSV and JSON need a schema."""
    if fmt in ("csv", "json") and schema is None:
        raise ValueError(f"reading {fmt} needs a schema")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingTable(path) from error
        raise


def read_rides(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, RIDES, fmt)


def read_baseline(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The baseline table for monitoring; a missing path is a ``MissingTable`` error."""
    return read_table(spark, path, schema)


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """JSON scoring requests, one document a line; see ``parse_requests``. Blank lines are no documents."""
    lines = read_table(spark, path, fmt="text")
    return parse_requests(lines.where(F.trim("value") != ""), "value")


def requests_from_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """A few in-memory requests as a table; a field a row lacks is NULL."""
    names = REQUEST.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], REQUEST)


# Strict JSON; Spark would also take single quotes.
JSON_OPTIONS = {"allowSingleQuotes": "false"}


def is_document(text: Column) -> Column:
    """Whether a text is one JSON object and nothing beside it.

    Spark's parser stops after the first value, and takes a list of objects for its first
    one. Inside brackets, and inside an object, a text passes only as a single whole value.
    """
    in_list = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", JSON_OPTIONS)
    in_object = F.from_json(F.concat(F.lit('{"d":'), text, F.lit("}")), "d string", JSON_OPTIONS)
    whole = (F.size(in_list) == 1) & in_object["d"].isNotNull()
    return F.coalesce(F.ltrim(text, F.lit(" \t\r\n")).startswith("{") & whole, F.lit(False))


def parse_requests(df: DataFrame, column: str) -> DataFrame:
    """Expand a column of JSON text into raw request fields, all text, so that validation sees the raw value.

    Text that is no JSON object (cut off, a list, a number, two documents, null) gives no
    fields; it stands in ``malformed_document``, which is null for the others. Of a repeated key the last value counts.
    """
    text = F.col(column)
    read = F.struct(is_document(text).alias("good"), F.from_json(text, as_text(REQUEST), JSON_OPTIONS).alias("request"))
    # Through a generator, so that the optimizer does not copy the parsing into each use of a field.
    parsed = df.withColumn("_read", F.explode(F.array(read)))
    good = F.col("_read.good")
    fields = [F.when(good, F.col(f"_read.request.{n}")).alias(n) for n in REQUEST.fieldNames()]
    raw = F.when(~good, F.coalesce(text, F.lit(""))).alias(MALFORMED)
    return parsed.select(*[c for c in df.columns if c not in (column, MALFORMED)], *fields, raw)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> None:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_best_metrics(best: DataFrame, path: str) -> None:
    """The one-row record of the best model as JSON."""
    best.select("best_model", "test_rmse", "test_r2", "test_mae", "training_time").write.mode(
        "overwrite"
    ).json(path)


RUN = "run"


def write_run(df: DataFrame, path: str, run_id: str, partition_by: list[str] | None = None) -> None:
    """Write the rows of one run into a table of runs. A run that is written again replaces its own rows, no others.

    A run without rows leaves what it wrote before; its id must not be empty.
    """
    if not run_id:
        raise ValueError("a run needs an id")
    by = [*(partition_by or []), RUN]
    named = df.withColumn(RUN, F.lit(run_id))
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all runs, with the column ``run`` as it was given: an id of digits stays text."""
    schema = read_table(spark, path).schema
    fields = [T.StructField(f.name, T.StringType()) if f.name == RUN else f for f in schema.fields]
    return read_table(spark, path, T.StructType(fields))


def append_drift_history(summary: DataFrame, path: str, run_id: str | None = None) -> None:
    """Add a run to the drift history, partitioned by the day of the run and its id.

    Without an id the run is known by its time, so a repeated run takes its own place.
    """
    if run_id is None:
        first = summary.agg(F.date_format(F.max("run_time"), "yyyy-MM-dd'T'HH-mm-ss.SSSSSS")).first()[0]
        if first is None:
            return
        run_id = first
    write_run(summary.withColumn("run_date", F.to_date("run_time")), path, run_id, ["run_date"])


def read_drift_history(spark: SparkSession, path: str) -> DataFrame:
    return read_runs(spark, path)


# The nested document of one drift run.
DRIFT_DOCUMENT = T.StructType(
    [
        T.StructField("run_time", T.StringType()),
        T.StructField("reference_rows", T.LongType()),
        T.StructField("current_rows", T.LongType()),
        T.StructField("dataset_drift", T.BooleanType()),
        T.StructField("n_drifted_features", T.LongType()),
        T.StructField("drifted_features", T.ArrayType(T.StringType())),
        T.StructField(
            "drift_scores",
            T.MapType(
                T.StringType(),
                T.StructType(
                    [
                        T.StructField("drift_detected", T.BooleanType()),
                        T.StructField("drift_score", T.DoubleType()),
                    ]
                ),
            ),
        ),
    ]
)


# One scenario of a simulation: its drift document without the run time, or its error.
SCENARIO_DOCUMENT = T.StructType(
    [
        T.StructField("scenario", T.StringType()),
        *[f for f in DRIFT_DOCUMENT.fields if f.name != "run_time"],
        T.StructField("error", T.StringType()),
    ]
)


def write_scenarios(summary: DataFrame, path: str) -> None:
    """The combined results of a simulation, one JSON document per scenario."""
    summary.write.mode("overwrite").json(path)


def read_scenarios(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, SCENARIO_DOCUMENT, "json")


def to_documents(df: DataFrame, alias: str = "document") -> DataFrame:
    """Each row as one JSON document."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(alias))


def document_score(document: Column, feature: str) -> tuple[Column, Column]:
    """Flag and score of one feature in a drift document; absent means no drift, 0."""
    entry = F.from_json(document, DRIFT_DOCUMENT).getField("drift_scores")[feature]
    return (
        F.coalesce(entry.getField("drift_detected"), F.lit(False)),
        F.coalesce(entry.getField("drift_score"), F.lit(0.0)),
    )


def label_score(label: Column) -> Column:
    """The number in text such as ``Drift score: 0.115``, NULL if there is none."""
    found = F.regexp_extract(label, r"Drift score: ([0-9.]+)", 1)
    return found.try_cast("double")
