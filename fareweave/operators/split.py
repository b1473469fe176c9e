"""Reproducible splits and samples by hash of a key.

The hash depends only on the key and a seed, so a row lands on the same side
whatever the partitioning. Exact sizes are found by counting rows per hash prefix
and never by ranking the whole table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fareweave.functions.numeric import hash_bucket, hash_hex

PREFIX_DIGITS = 4  # 65,536 counts a round
HASH = "_hash"


def split_label(key: str | list[str], test_share: float, seed: int) -> Column:
    """``train`` or ``test`` from the row alone: no shuffle, size near the share."""
    percent = round(test_share * 100)
    return F.when(hash_bucket(key, seed, 100) < percent, "test").otherwise("train")


def hash_split(df: DataFrame, key: str | list[str], test_share: float, seed: int) -> DataFrame:
    return df.withColumn("split", split_label(key, test_share, seed))


def _cut(digests: DataFrame, n: int) -> tuple[str, int, int] | None:
    """Where the ``n`` smallest of a column ``_hash`` end: the digest there, how many are smaller, how many equal.

    Rows are counted by the first digits of their digest, then by further digits among
    those that begin like the one at the cut. None means that every row qualifies.
    """
    prefix, below = "", 0
    while True:
        size = len(prefix) + PREFIX_DIGITS
        inside = digests.where(F.col(HASH).startswith(prefix)) if prefix else digests
        counts = inside.groupBy(F.substring(HASH, 1, size).alias("prefix")).agg(
            F.count(F.lit(1)).alias("n"), F.min(HASH).alias("first"), F.max(HASH).alias("last")
        )
        upto = F.sum("n").over(W.orderBy("prefix").rowsBetween(W.unboundedPreceding, W.currentRow))
        found = counts.withColumn("upto", upto + below).where(F.col("upto") >= n).orderBy("prefix").first()
        if found is None:
            return None
        prefix, below = found["prefix"], found["upto"] - found["n"]
        if found["first"] == found["last"]:
            return found["first"], below, found["n"]


def _parts(df: DataFrame, key: str | list[str], n: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The ``n`` rows with the lowest digests of their key (all, if there are fewer), and the others.

    Rows that share the digest at the cut are put in order by a digest of the whole row;
    rows that are wholly equal are counted and dealt out by number.
    """
    if n <= 0:
        return df.limit(0), df
    own = hash_hex(key, seed)
    cut = _cut(df.select(own.alias(HASH)), n)
    if cut is None:
        return df, df.limit(0)
    digest, below, equal = cut
    low, high, left = own < digest, own > digest, n - below
    if left == equal:
        return df.where(own <= digest), df.where(high)
    whole = F.md5(F.to_json(F.struct(*df.columns)))
    tied = df.where(own == digest)
    digest2, below2, equal2 = _cut(tied.select(whole.alias(HASH)), left)
    here = own == digest
    taken = df.where(low | (here & (whole < digest2)))
    rest = df.where(high | (here & (whole > digest2)))
    same = tied.where(whole == digest2).limit(1)

    def repeated(times: int) -> DataFrame:
        copies = F.explode(F.sequence(F.lit(1), F.lit(times)))
        return same.withColumn(HASH, copies).drop(HASH) if times else same.limit(0)

    return (
        taken.unionByName(repeated(left - below2)),
        rest.unionByName(repeated(equal2 - left + below2)),
    )


def exact_split(df: DataFrame, key: str | list[str], test_share: float, seed: int) -> DataFrame:
    """Split with exactly ``ceil(test_share * rows)`` test rows. Keys may be missing or shared."""
    test, train = _parts(df, key, math.ceil(test_share * df.count()), seed)
    return test.withColumn("split", F.lit("test")).unionByName(train.withColumn("split", F.lit("train")))


def exact_sample(df: DataFrame, key: str | list[str], n: int, seed: int) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer) without replacement. Keys may be missing or shared.

    A sorted limit would send ``n`` rows of every partition to one task; the cut of
    the digests needs only counts, and then every task filters its own rows.
    """
    return _parts(df, key, n, seed)[0]


def first_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """A preview: the rows with the smallest keys."""
    return df.orderBy(key).limit(n)


def union_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    """All rows of both splits, duplicates kept."""
    return train.unionByName(test)
