"""Column expressions for clipping, rounding, casting and missing values."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limit to [low, high]; NULL and NaN stay as they are."""
    out = F
    if low is not None:
        out = out.when(c < low, F.lit(low).cast("double"))
    if high is not None:
        out = out.when((c > high) & ~F.isnan(c), F.lit(high).cast("double"))
    return c if out is F else out.otherwise(c)


def round_half_even(c: Column, decimals: int) -> Column:
    """Round by scaling, rounding halves to even, and unscaling."""
    scale = float(10**decimals)
    return F.rint(c * scale) / scale


def truncate(c: Column, to: str = "int") -> Column:
    """Cast to an integer type towards zero."""
    return c.cast(to)


def missing(c: Column, floating: bool) -> Column:
    """NULL, or NaN in a floating column."""
    return c.isNull() | F.isnan(c) if floating else c.isNull()


def present(c: Column) -> Column:
    """Neither NULL nor NaN."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double")).isNotNull()


def nan_to_null(c: Column) -> Column:
    """NaN counts as missing in every fit and profile."""
    return F.nanvl(c, F.lit(None).cast("double"))


def cyclical(c: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a position on a cycle."""
    angle = F.lit(2 * math.pi) * c / F.lit(period)
    return F.sin(angle), F.cos(angle)


def lookup(c: Column, mapping: dict, default) -> Column:
    """Map values through a small dictionary; anything else gets the default."""
    out = F
    for key, value in mapping.items():
        out = out.when(c == key, F.lit(value))
    return out.otherwise(F.lit(default))


def hash_hex(key: str | list[str], seed: int) -> Column:
    """Hex digest of the key and a seed: a reproducible random order of the rows.

    A missing part of the key has a mark of its own, so it keeps its place.
    """
    keys = [key] if isinstance(key, str) else key
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in keys]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def hash_bucket(key: str | list[str], seed: int, buckets: int) -> Column:
    """Bucket 0..buckets-1 from the first eight hex digits of ``hash_hex``."""
    return F.conv(F.substring(hash_hex(key, seed), 1, 8), 16, 10).cast("long") % buckets
