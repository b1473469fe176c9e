"""Missing values: profile, fit and fill."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareweave.functions.numeric import missing
from fareweave.operators.counts import value_counts
from fareweave.operators.quantiles import quantiles_of_counts
from fareweave.operators.sketches import approx_medians
from fareweave.schema import boolean_columns, categorical_columns, is_floating, numeric_columns
from fareweave.storage import materialize

ROWS = "_rows"  # the feature that counts rows


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: rows and missing values (NULL, and NaN in floating columns)."""
    names = df.columns if columns is None else columns
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(missing(F.col(c), is_floating(df, c))).alias(c) for c in names],
    )
    return (
        counted.unpivot(["_rows"], names, "column_name", "missing_count")
        .withColumnRenamed("_rows", "row_count")
        .withColumn("has_missing", F.col("missing_count") > 0)
        .select("column_name", "row_count", "missing_count", "has_missing")
    )


@dataclass(frozen=True)
class Imputer:
    """Fitted fill values of all columns: medians of numeric, modes of string and boolean ones."""

    medians: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str | bool] = field(default_factory=dict)
    # Numeric columns that had missing values where the medians were learnt.
    gaps: tuple[str, ...] = ()
    # Columns with missing values but no value to learn from; left as they are.
    empty: tuple[str, ...] = ()

    def transform(self, df: DataFrame) -> DataFrame:
        """Fill missing values.

        An integer column that had gaps in the fitted rows becomes double; one that had
        none keeps its type, and a gap that turns up later takes the median rounded half
        to even.
        """
        filled = {}
        for name, value in self.medians.items():
            if name in df.columns:
                c = F.col(name)
                gap = missing(c, is_floating(df, name))
                if name in self.gaps or is_floating(df, name):
                    filled[name] = F.when(gap, F.lit(value)).otherwise(c.cast("double"))
                else:
                    filled[name] = F.when(gap, F.rint(F.lit(value)).cast(df.schema[name].dataType)).otherwise(c)
        for name, value in self.modes.items():
            if name in df.columns:
                filled[name] = F.coalesce(F.col(name), F.lit(value))
        return df.withColumns(filled) if filled else df


def column_counts(df: DataFrame, numeric: list[str], text: list[str]) -> DataFrame:
    """Rows per (feature, value) of all columns, and of the table as feature ``_rows``: one scan, written once.

    Numbers stand in ``x``, texts and truth values in ``v``; missing values are not counted.
    """
    ready = df.select(*numeric, *[F.col(c).cast("string").alias(c) for c in text], F.lit(1.0).alias(ROWS))
    return materialize(value_counts(ready, [*numeric, ROWS], text), "column-counts")


def modes_of_counts(counts: DataFrame, columns: list[str]) -> dict[str, str | None]:
    """Most frequent value per column as text, the smallest one on ties; the driver reads a row per column."""
    mine = counts.where(F.col("feature").isin(columns) & F.col("v").isNotNull())
    best = mine.groupBy("feature").agg(F.min(F.struct((-F.col("n")).alias("negative"), F.col("v"))).alias("best"))
    modes = {r["feature"]: r["best"]["v"] for r in best.collect()}
    return {c: modes.get(c) for c in columns}


def column_modes(df: DataFrame, columns: list[str]) -> dict[str, str | None]:
    """Most frequent value per string or boolean column as text, the smallest one on ties.

    Values are counted in a shuffle by (column, value), so a column with very many
    distinct values is never held by one task.
    """
    if not columns:
        return {}
    return modes_of_counts(value_counts(df.select(*[F.col(c).cast("string").alias(c) for c in columns]), [], columns), columns)


def _classes(df: DataFrame, names: list[str]) -> tuple[list[str], list[str], list[str]]:
    """Numeric columns, boolean ones, and all that have modes."""
    booleans = [c for c in boolean_columns(df) if c in names]
    return [c for c in numeric_columns(df) if c in names], booleans, [c for c in categorical_columns(df) if c in names] + booleans


def fit_imputer(
    df: DataFrame, skip: list[str] | None = None, columns: list[str] | None = None, approx: bool = False
) -> Imputer:
    """Learn a fill value for every column, whether or not it has missing values in these rows.

    All of it comes from one scan, the counts of the columns' values. With ``approx``, numbers are
    not counted by value: their medians come from sketches, a value of the column whose rank is
    within ``sketches.rank_error()`` of the middle.
    """
    return fit_imputer_and_counts(df, skip, columns, approx)[0]


def fit_imputer_and_counts(
    df: DataFrame, skip: list[str] | None = None, columns: list[str] | None = None, approx: bool = False
) -> tuple[Imputer, DataFrame | None]:
    """The imputer and the counts it was learnt from, which also list the categories."""
    names = [c for c in (columns or df.columns) if c not in (skip or [])]
    numeric, booleans, text = _classes(df, names)
    if not numeric + text:
        return Imputer(), None
    counts = column_counts(df, [] if approx else numeric, text)
    sizes = {r["feature"]: r["n"] for r in counts.groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    if approx:
        medians, known = approx_medians(df, numeric)
        sizes |= known
    else:
        medians = {c: q[0] for c, q in quantiles_of_counts(counts, numeric, [0.5]).items()}
    modes = modes_of_counts(counts, text) if text else {}
    imputer = Imputer(
        medians={c: q for c, q in medians.items() if q is not None},
        modes={c: m == "true" if c in booleans else m for c, m in modes.items() if m is not None},
        gaps=tuple(c for c in numeric if sizes.get(c, 0) < sizes.get(ROWS, 0)),
        empty=tuple([c for c, q in medians.items() if q is None] + [c for c, m in modes.items() if m is None]),
    )
    return imputer, counts


def handle_missing_values(df: DataFrame) -> DataFrame:
    """Fit and fill on the same table."""
    return fit_imputer(df).transform(df)


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop columns; names that are absent are ignored."""
    return df.drop(*columns)
