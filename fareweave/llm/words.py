"""Splitting texts by a tokenizer's pattern, in Spark, and handling each distinct piece once."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 6_000_000  # of pieces handled at once
CACHED_PIECES = 150_000  # a task forgets what it knows about pieces beyond this
PACKED_PIECES = 1_000_000  # the same, for pieces in packed form
PACKED_BYTES = 32_000_000  # of packed pieces and their ids


# The byte-level pattern for Spark's engine: the same matches, but a run of one kind is never given back.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPARK_FORMS = {
    BYTE_LEVEL: r"(?U)'(?:[stmd]|re|ve|ll)| ?+\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"
}
UNASSIGNED = r"[\x{250}-\x{10FFFF}&&\p{Cn}]"  # below, all characters are assigned


def split_texts(docs: DataFrame, id_col: str, text_col: str, pattern: str, special: Sequence[str] = ()) -> DataFrame:
    """(id, pieces, odd, n_bytes) for each row: all matches of the pattern in its text; a null text is empty.

    Spark's regular expressions know an older Unicode, and special strings are taken out
    before the pattern applies: texts with characters that Spark takes for unassigned, or
    with special strings, are handed on whole, as ``odd``, with null pieces.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    odd = (F.length(text) < F.octet_length(text)) & text.rlike(UNASSIGNED)
    for s in special:
        odd = odd | text.contains(s)
    marked = docs.select(F.col(id_col).alias("id"), text.alias("text"), odd.alias("is_odd"))
    return marked.select(
        "id",
        F.when(~F.col("is_odd"), F.regexp_extract_all("text", F.lit(SPARK_FORMS.get(pattern, f"(?U){pattern}")), F.lit(0))).alias("pieces"),
        F.when(F.col("is_odd"), F.col("text")).alias("odd"),
        F.octet_length("text").cast("long").alias("n_bytes"),
    )


def piece_lists(
    batch: pa.RecordBatch, split: Callable[[str], list[str]]
) -> Iterator[tuple[int, int, pa.ListArray]]:
    """(first row, end row, pieces) for slices of a batch of ``split_texts``; ``split`` cuts the odd texts."""
    lists, odd = batch.column("pieces"), batch.column("odd")
    if odd.null_count < len(odd):
        both = zip(lists.to_pylist(), odd.to_pylist(), strict=True)
        lists = pa.array([p if o is None else split(o) for p, o in both], pa.list_(pa.string()))
    offsets = lists.offsets.to_numpy()
    lengths = pc.binary_length(lists.values).to_numpy(zero_copy_only=False).astype(np.int64)
    # A piece costs its bytes and its bookkeeping.
    cost = np.concatenate([[0], np.cumsum(lengths + 4)])[offsets]
    first = 0
    while first < len(lists):
        end = max(first + 1, int(np.searchsorted(cost, cost[first] + SLICE_BYTES, side="right")) - 1)
        yield first, end, lists.slice(first, end - first)
        first = end


class PieceCache:
    """What a worker knows about pieces. ``learn`` gets a list of new ones and gives a value for each."""

    def __init__(self, learn: Callable[[list[str]], list]):
        self.learn, self.known = learn, {}

    def values(self, wanted: list[str]) -> list:
        if len(self.known) > CACHED_PIECES:
            self.known.clear()
        known = self.known
        new = [w for w in wanted if w not in known]
        known.update(zip(new, self.learn(new), strict=True))
        return [known[w] for w in wanted]


class PieceIds:
    """What a task knows about pieces' token ids, packed into arrays: some tens of bytes for a piece and its ids.

    ``learn`` gets a list of new pieces and gives the ids of each as bytes of ``dtype``.
    """

    def __init__(self, learn: Callable[[list[str]], list[bytes]], dtype: type):
        self.learn, self.dtype = learn, dtype
        self.forget()

    def forget(self) -> None:
        self.pieces = pa.array([], pa.string())
        self.ids = np.zeros(0, self.dtype)
        self.ends = np.zeros(1, np.int64)  # piece i has the ids from ends[i] to ends[i + 1]

    def places(self, wanted: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """For distinct pieces: where the ids of each start in ``ids``, and how many there are."""
        if len(self.pieces) > PACKED_PIECES or self.pieces.nbytes + self.ids.nbytes > PACKED_BYTES:
            self.forget()
        at = pc.index_in(wanted, value_set=self.pieces)
        if at.null_count:
            new = wanted.filter(at.is_null())
            values = self.learn(new.to_numpy(zero_copy_only=False).tolist())
            sizes = np.fromiter(map(len, values), np.int64, len(values)) // np.dtype(self.dtype).itemsize
            number = np.arange(len(self.pieces), len(self.pieces) + len(new), dtype=np.int32)
            at = pc.replace_with_mask(at, at.is_null(), pa.array(number))
            self.pieces = pa.concat_arrays([self.pieces, new])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(values), self.dtype)])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        at = at.to_numpy()
        return self.ends[at], self.ends[at + 1] - self.ends[at]


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Rows go to Python so many at a time, in what is run within; long texts then need little room."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def free_memory() -> None:
    """Hand back what a task has used: workers live on, and the next stage needs the room."""
    gc.collect()
    pa.default_memory_pool().release_unused()


def coded_pieces(lists: pa.ListArray, cache: PieceCache) -> tuple[np.ndarray, list[str], list, np.ndarray]:
    """Where each list begins and ends, the distinct pieces, what the cache knows of them, and all pieces by number."""
    coded = lists.flatten().dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    return bounds, distinct, cache.values(distinct), coded.indices.to_numpy()


def join_ids(lists: pa.ListArray, cache: PieceIds) -> tuple[np.ndarray, np.ndarray]:
    """The ids of each list of pieces: offsets, and all ids in a row."""
    coded = lists.flatten().dictionary_encode()
    starts, sizes = cache.places(coded.dictionary)
    at = coded.indices.to_numpy()
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    bounds = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    lengths = sizes[at]
    ends = np.cumsum(lengths)
    places = np.repeat((starts[at] - (ends - lengths)).astype(np.int32), lengths)
    places += np.arange(len(places), dtype=np.int32)
    return np.concatenate([[0], ends])[bounds], cache.ids[places]
