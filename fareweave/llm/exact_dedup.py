"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Every part of the table sends the sorted, distinct 64-bit fingerprints of its texts to
their owners, Golomb-Rice coded. An owner holds one range of fingerprints; it decodes
what all parts sent, and answers each message with a bitmap: which of the fingerprints
occur elsewhere too. A part marks those and the ones it holds several times itself as
suspects. Only the texts of suspects are then shuffled and compared byte by byte.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareweave.storage import delete_path, materialize, scratch_path

# Fingerprints of suspects that may be broadcast: 8 bytes each, 16 MB in all.
BROADCAST_PRINTS = 2_000_000


def rice_encode(numbers: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit numbers as one message.

    A byte for the width w, eight bytes for the first number, then the gaps: the low w
    bits of all gaps packed at fixed width, and the rest of each gap in unary, a one
    after as many zeros. w is the whole part of log2 of the mean gap.
    """
    numbers = np.asarray(numbers, dtype=np.uint64)
    if not len(numbers):
        return b""
    gaps = np.diff(numbers)
    width = int(np.log2(max(1.0, float(gaps.mean())))) if len(gaps) else 0
    shift = np.uint64(width)
    rest = (gaps >> shift).astype(np.int64)
    ones = np.cumsum(rest + 1) - 1
    unary = np.zeros(int(ones[-1]) + 1 if len(ones) else 0, dtype=np.uint8)
    unary[ones] = 1
    columns = (gaps[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    low = np.packbits(columns.astype(np.uint8).ravel()).tobytes()
    head = bytes([width]) + int(numbers[0]).to_bytes(8, "little") + len(gaps).to_bytes(8, "little")
    return head + low + np.packbits(unary).tobytes()


def rice_decode(message: bytes) -> np.ndarray:
    """The numbers of a message of ``rice_encode``."""
    if not message:
        return np.zeros(0, dtype=np.uint64)
    width, first = message[0], int.from_bytes(message[1:9], "little")
    count = int.from_bytes(message[9:17], "little")
    low_bytes = (count * width + 7) // 8
    low = np.frombuffer(message, np.uint8, low_bytes, 17)
    bits = np.unpackbits(low)[: count * width].reshape(count, width).astype(np.uint64)
    gaps = (bits << np.arange(width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    unary = np.unpackbits(np.frombuffer(message, np.uint8, offset=17 + low_bytes))
    ones = np.flatnonzero(unary)[:count]
    rest = np.diff(ones, prepend=-1) - 1
    gaps += rest.astype(np.uint64) << np.uint64(width)
    return np.concatenate([[np.uint64(first)], np.uint64(first) + np.cumsum(gaps, dtype=np.uint64)])


def _owner(prints: np.ndarray, owners: int) -> np.ndarray:
    """Owners hold equal ranges of the upper 32 bits."""
    return ((prints >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int32)


def _send(owners: int):
    """The messages of one part."""

    def send(part: pd.DataFrame) -> pd.DataFrame:
        prints = np.unique(part["print"].to_numpy(np.int64).view(np.uint64))
        owner = _owner(prints, owners)
        cuts = np.flatnonzero(np.diff(owner)) + 1
        groups = np.split(prints, cuts)
        return pd.DataFrame(
            {
                "owner": owner[np.concatenate([[0], cuts])],
                "part": np.full(len(groups), part["part"].iloc[0], dtype=np.int64),
                "message": [rice_encode(g) for g in groups],
            }
        )

    return send


def _answer(messages: pd.DataFrame) -> pd.DataFrame:
    """An owner's answers: for each message, which of its fingerprints another message holds too."""
    decoded = [rice_decode(m) for m in messages["message"]]
    everything = np.sort(np.concatenate(decoded))
    twice = np.unique(everything[1:][everything[1:] == everything[:-1]])
    return pd.DataFrame(
        {
            "owner": messages["owner"],
            "part": messages["part"],
            "bitmap": [np.packbits(np.isin(d, twice)).tobytes() for d in decoded],
        }
    )


def _mark(owners: int):
    """The rows of a part whose fingerprint is the part's or another's as well."""

    def mark(part: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        every, counts = np.unique(part["print"].to_numpy(np.int64).view(np.uint64), return_counts=True)
        suspect = counts > 1
        owner = _owner(every, owners)
        for o, bitmap in zip(answers["owner"], answers["bitmap"], strict=True):
            own = np.flatnonzero(owner == o)
            bits = np.unpackbits(np.frombuffer(bitmap, np.uint8))[: len(own)]
            suspect[own] |= bits.astype(bool)
        found = np.isin(part["print"].to_numpy(np.int64).view(np.uint64), every[suspect])
        return part.loc[found, ["row"]]

    return mark


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owners: int | None = None
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; a null text equals an empty one. Of equal
    texts the row with the largest id is kept: ``keep_id`` is that id, ``group_size``
    counts the group, and ``kept`` holds for exactly one row of each group. A null id is
    smaller than all others; of rows with the same text and id, one is kept. Other
    columns of ``docs`` are not looked at. An empty table gives an empty table.

    The 64-bit fingerprint only chooses suspects. Equal texts always share it, so nothing
    is missed; texts that share it by chance are told apart when their bytes are compared.

    A group of any size costs each part one fingerprint and each task one text. Parts are
    the partitions in which ``docs`` is read, of bounded size. The suspects' fingerprints
    are broadcast to the second scan if they are at most BROADCAST_PRINTS; beyond that, the
    bytes of all texts are compared, with the same result.
    """
    spark = docs.sparkSession
    owners = owners or int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialize(
        docs.select(
            F.col(id_col).alias("id"),
            F.xxhash64(text).alias("print"),
            F.sha2(text, 256).alias("sha"),
            F.spark_partition_id().cast("long").alias("part"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "prints",
    )
    parts = rows.select("part", "row", "print")
    messages = parts.groupBy("part").applyInPandas(_send(owners), "owner int, part long, message binary")
    answers = messages.groupBy("owner").applyInPandas(_answer, "owner int, part long, bitmap binary")
    marked_path = scratch_path(spark, "suspects")
    parts.groupBy("part").cogroup(answers.groupBy("part")).applyInPandas(_mark(owners), "row long").write.parquet(
        marked_path
    )
    marked = spark.read.schema("row long").parquet(marked_path)
    suspects = materialize(rows.join(marked, "row"), "suspect-rows")
    delete_path(spark, marked_path)

    prints = suspects.select("print").distinct()
    texts = docs.select(F.xxhash64(text).alias("print"), text.alias("text"))
    if prints.count() <= BROADCAST_PRINTS:
        texts = texts.join(F.broadcast(prints), "print", "left_semi")
    # Grouping by the text itself compares bytes; each task sends a text once, with a count.
    equal = (
        texts.groupBy("print", "text")
        .agg(F.count("*").alias("group_size"))
        .where("group_size > 1")
        .select("print", F.sha2("text", 256).alias("sha"), "group_size")
    )
    winners = (
        suspects.groupBy("print", "sha")
        .agg(F.max(F.struct("id", "row")).alias("winner"))
        .select("print", "sha", "winner.id", "winner.row")
    )
    groups = materialize(
        equal.join(winners, ["print", "sha"]).select(
            "sha", "group_size", F.col("id").alias("keep_id"), F.col("row").alias("keep_row")
        ),
        "groups",
    )
    alone = F.col("group_size").isNull()
    return rows.join(groups, "sha", "left").select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_duplicates`` keeps, with all their columns.

    Rows are recognised by id and text. Only where rows share both, one of them is
    picked in a step of its own: of rows that differ in other columns alone, any may be the
    one. The rows meet the verdicts in a sorted join at every size.
    """
    verdicts = materialize(exact_duplicates(docs, id_col, text_col).where("group_size > 1"), "verdicts")
    same_id = F.col(id_col).eqNullSafe(F.col("keep_id"))
    key = [F.col(id_col).alias("_id"), F.col("text_sha256").alias("_sha")]
    losers = verdicts.where(~same_id).select(*key)
    repeated = verdicts.where(same_id & ~F.col("kept")).select(*key).distinct()
    mark = "_text_sha256"
    while mark in docs.columns:
        mark += "_"
    rows = docs.withColumn(mark, F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))

    def matches(other: DataFrame):
        return (F.col(mark) == other["_sha"]) & F.col(id_col).eqNullSafe(other["_id"])

    losers = losers.hint("merge")
    stay = rows.join(losers, matches(losers), "left_anti")
    if not repeated.isEmpty():
        one = stay.join(repeated, matches(repeated), "left_semi").dropDuplicates([id_col, mark])
        stay = stay.join(repeated, matches(repeated), "left_anti").unionByName(one)
    return stay.drop(mark)
