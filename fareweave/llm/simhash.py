"""Near-duplicates by SimHash, with covering masks instead of random tables.

A text's fingerprint has 64 bits. For a radius r there are 2^(r+1) - 1 masks. Each bit
has a non-zero vector of r+1 bits; a mask is named by a non-zero vector too, and keeps
the bits whose vector has an odd inner product with it. Two fingerprints that differ in
at most r places agree under some mask: the vectors of the r places span too little for
every mask name to have an odd product with one of them. So each pair within the radius
meets in some table, without chance, and no other comparison is needed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareweave.llm.components import connected_components
from fareweave.llm.words import small_batches
from fareweave.storage import materialize

BITS = 64
BLOCK = 4096  # fingerprints compared at once
PENDING = 60_000  # hashes whose bits are counted at once


def covering_masks(radius: int) -> list[int]:
    """The masks for a radius, as unsigned numbers."""
    names = range(1, 2 ** (radius + 1))
    vectors = [names[i % len(names)] for i in range(BITS)]
    return [sum(1 << i for i, v in enumerate(vectors) if (v & name).bit_count() % 2) for name in names]


def _hashes(text: bytes, length: int, seed: int) -> list[int]:
    """XXH64 of each run of ``length`` words, joined by spaces; of all words where there are fewer."""
    words = text.lower().split()  # bytes: lowers A-Z alone, splits at 20 and 09 to 0D
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= length:
        return [xxhash.xxh64_intdigest(line, seed)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-length] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], seed) for a, b in zip(starts, ends[length - 1 :].tolist(), strict=True)]


def _bit_counts(hashes: np.ndarray, starts: list[int]) -> np.ndarray:
    """How often each bit is set, for each run of hashes that begins at one of ``starts``."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int64)


def _fingerprints(texts: Iterator[bytes | None], length: int, seed: int) -> np.ndarray:
    """A fingerprint for each text. At most PENDING hashes and one text are expanded to bits at a time."""
    counts: list[np.ndarray] = []
    totals: list[int] = []
    hashes: list[int] = []
    starts: list[int] = []

    def flush() -> None:
        if starts:
            counts.append(_bit_counts(np.array(hashes, dtype=np.uint64), starts))
            hashes.clear()
            starts.clear()

    for text in texts:
        own = _hashes(text or b"", length, seed)
        totals.append(len(own))
        if len(own) > PENDING:
            flush()
            parts = [np.array(own[i : i + PENDING], dtype=np.uint64) for i in range(0, len(own), PENDING)]
            counts.append(sum(_bit_counts(p, [0]) for p in parts))
            continue
        if own:
            starts.append(len(hashes))
            hashes += own
        else:
            flush()
            counts.append(np.zeros((1, BITS), dtype=np.int64))
        if len(hashes) > PENDING:
            flush()
    flush()
    if not counts:
        return np.zeros(0, dtype=np.uint64)
    over_half = (np.concatenate(counts) * 2 > np.array(totals)[:, None]).astype(np.uint8)
    return np.packbits(over_half, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42
) -> DataFrame:
    """One row (id, fingerprint as a long) per row of ``docs``.

    A-Z are lowered; words are runs of other characters than space and 09 to 0D. A bit is
    set if over half of the hashes of the word shingles, repeats included, have it. A
    text with fewer words than a shingle counts as one shingle; null and empty texts and
    those without words have fingerprint zero.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            prints = _fingerprints((t.as_py() for t in texts), shingle, seed)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints.view(np.int64))], ["id", "print"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(compute, f"id {kind}, print long").select(
        F.col("id").alias(id_col), F.col("print").alias("fingerprint")
    )


def _stars(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links from each fingerprint of a bucket to the least of its component, where they are within reach by steps."""
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius
    root = np.arange(len(prints))
    todo = np.ones(len(prints), dtype=bool)
    for first in range(len(prints)):
        if not todo[first]:
            continue
        front = np.zeros(len(prints), dtype=bool)
        front[first] = True
        while front.any():
            todo &= ~front
            root[front] = first
            front = near[front].any(axis=0) & todo
    moved = np.flatnonzero(root != np.arange(len(prints)))
    return prints[moved], prints[root[moved]]


def _bucket_links(radius: int):
    """Links within each run of rows with equal bucket. Rows come sorted by bucket."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = ["mask", "key", "low", "high"]
        rest = {c: np.zeros(0, dtype=np.int64) for c in [*bucket, "print"]}

        def closed(part: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
            size = len(part["print"])
            if not size:
                return
            change = np.zeros(size, dtype=bool)
            change[0] = True
            for c in bucket:
                change[1:] |= part[c][1:] != part[c][:-1]
            starts = np.flatnonzero(change)
            sizes = np.diff(starts, append=size)
            prints = part["print"].view(np.uint64)
            twos = starts[sizes == 2]
            twos = twos[np.bitwise_count(prints[twos] ^ prints[twos + 1]) <= radius]
            found = [(prints[twos], prints[twos + 1])]
            for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                found.append(_stars(prints[s : s + n], radius))
            pairs = np.unique(np.stack([np.concatenate(x) for x in zip(*found, strict=True)], axis=1), axis=0)
            if len(pairs):
                pairs = np.ascontiguousarray(pairs.T).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

        for batch in batches:
            part = {c: np.concatenate([rest[c], batch.column(c).to_numpy().astype(np.int64)]) for c in rest}
            last = len(part["print"])
            if last:  # the last run may go on in the next batch
                same = np.ones(last, dtype=bool)
                for c in bucket:
                    same &= part[c] == part[c][-1]
                last = last - int(np.argmin(same[::-1])) if not same.all() else 0
            rest = {c: v[last:] for c, v in part.items()}
            yield from closed({c: v[:last] for c, v in part.items()})
        yield from closed(rest)

    return links


def fingerprint_links(prints: DataFrame, radius: int = 4) -> DataFrame:
    """Links (a, b) that connect just what the pairs of distinct ``fingerprint`` within ``radius`` bits connect.

    Every pair within the radius is compared in at least one bucket; a bucket then gives
    a star per connected set rather than all its pairs. A bucket of over BLOCK
    fingerprints is cut into parts, and each two parts are compared in a task of their
    own, so no task holds more than a few blocks and no pair is left out.
    """
    masks = [m - (1 << 64) if m >> 63 else m for m in covering_masks(radius)]
    # A fingerprint becomes a row for each mask: narrow rows are dealt out first.
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = prints.repartition(tasks).select(
        F.col("fingerprint").alias("print"),
        F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(F.lit(m)) for m in masks])).alias("mask", "key"),
    )
    large = materialize(
        keyed.groupBy("mask", "key").count().where(F.col("count") > BLOCK), "large-buckets"
    ).withColumn("parts", F.ceil(F.col("count") / BLOCK).cast("int"))
    parts = F.coalesce("parts", F.lit(1))
    own = F.pmod(F.xxhash64("print"), parts).cast("int")
    dealt = (
        keyed.join(large.drop("count"), ["mask", "key"], "left")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .select("mask", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "print")
    )
    bucket = ["mask", "key", "low", "high"]
    return dealt.repartition(*bucket).sortWithinPartitions(*bucket, "print").mapInArrow(
        _bucket_links(radius), "a long, b long"
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    radius: int = 4,
    seed: int = 42,
) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hexadecimal digits), component_id.

    Texts are linked if their fingerprints differ in at most ``radius`` bits; a component
    is all that links reach, and ``component_id`` its least id. Equal fingerprints are
    one node, so copies cost nothing after the first count. Null ids are passed over when
    the least is sought; a component without any id has a null component_id. For null and
    empty texts see ``fingerprints``: they link with each other. Other columns of
    ``docs`` are not looked at. An empty table gives an empty table.
    """
    with small_batches(docs.sparkSession):
        rows = materialize(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    prints = materialize(rows.groupBy("fingerprint").agg(F.min(id_col).alias("least_id")), "distinct-fingerprints")
    links = fingerprint_links(prints.select("fingerprint"), radius)
    members = connected_components(links).select(F.col("node").alias("fingerprint"), "component")
    rooted = prints.join(members, "fingerprint", "left").withColumn(
        "component", F.coalesce("component", "fingerprint")
    )
    ids = rooted.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = materialize(rooted.join(ids, "component").select("fingerprint", "component_id"), "named-fingerprints")
    return rows.join(named, "fingerprint").select(
        id_col, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose id is the least of their component, with all columns; see ``near_duplicates``.

    Of rows with the same id, those of other components stay; those of one component
    stay together if their id is its least. Rows without an id stay if nothing in their
    component has one.
    """
    verdicts = near_duplicates(docs, id_col, text_col, **options)
    differs = ~F.col(id_col).eqNullSafe(F.col("component_id"))
    dropped = verdicts.where(differs).select(F.col(id_col).alias("_id")).distinct()
    kept = verdicts.where(~differs).select(F.col(id_col).alias("_id")).distinct()
    gone = materialize(dropped.subtract(kept), "near-copies")
    return docs.join(gone, F.col(id_col).eqNullSafe(gone["_id"]), "left_anti")
