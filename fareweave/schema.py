"""Fixed schemas and column classification by data type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

RIDES = T.StructType(
    [
        T.StructField("ride_id", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("hour_of_day", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("is_weekend", T.BooleanType()),
        T.StructField("passenger_demand", T.LongType()),
        T.StructField("driver_availability", T.LongType()),
        T.StructField("weather_condition", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("visibility_km", T.DoubleType()),
        T.StructField("base_fare", T.DoubleType()),
        T.StructField("price_multiplier", T.DoubleType()),
    ]
)

# A scoring request: the ride columns known before the ride is priced.
REQUEST = T.StructType(
    [f for f in RIDES.fields if f.name not in ("ride_id", "timestamp", "price_multiplier")]
)

# The text of a request document that could not be read.
MALFORMED = "malformed_document"

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns, all strings: for untrusted input that is cast later."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns with a numeric type; booleans and timestamps are not numeric."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def categorical_columns(df: DataFrame) -> list[str]:
    """Columns with a string type."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def boolean_columns(df: DataFrame) -> list[str]:
    """Columns with a boolean type: two categories."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]


def is_floating(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))


def select_by_class(df: DataFrame, kind: str) -> DataFrame:
    """Keep the columns of one class: ``numeric`` or ``categorical``."""
    pick = {"numeric": numeric_columns, "categorical": categorical_columns}[kind]
    return df.select(*pick(df))
