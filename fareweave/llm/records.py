"""Token ids as length-delimited binary records, with a separate offset index.

A record is a frame: the payload's length (8 bytes), its masked checksum (4), the
payload, the payload's masked checksum (4) and a line feed. The payload is one flag byte
(an id follows or not), the document's id (8), the width of a token id in bytes (1) and
the token ids. Numbers are little-endian; a checksum is the CRC-32 of the bytes,
rotated and shifted, so that checksums of data that holds checksums stay useful.

Spark's own text writer writes the frames, one to a line, so files appear only when a
task has succeeded, on any file system that Spark can write to. Files hold ranges of
ascending document ids; the number in a file's name gives its place.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fareweave.llm.library import library_tokenizer, settings
from fareweave.llm.words import join_ids, piece_lists, small_batches, split_texts

FILE_TEXT = 32_000_000  # bytes of text whose ids share a file
FILES_AT_ONCE = 1024  # files whose totals one task adds up
HEAD = struct.Struct("<QI")
TAIL = struct.Struct("<Ic")
OWN = struct.Struct("<?qB")


class BadRecord(ValueError):
    """A frame that does not match its lengths or checksums."""


def masked(data: bytes) -> int:
    """The masked checksum: CRC-32 rotated right by 15 bits, plus a constant."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    """A record as it stands in a file, but for the line feed, which the writer sets."""
    payload = OWN.pack(doc_id is not None, doc_id or 0, ids.dtype.itemsize) + ids.tobytes()
    length = struct.pack("<Q", len(payload))
    return b"".join([length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))])


def lengths(data: bytes) -> Iterator[tuple[int, int]]:
    """(offset, payload length) of each record of a file; the lengths' checksums are verified."""
    at = 0
    while at < len(data):
        if at + HEAD.size > len(data):
            raise BadRecord(f"no whole record at {at}")
        size, check = HEAD.unpack_from(data, at)
        if masked(data[at : at + 8]) != check or at + HEAD.size + size + TAIL.size > len(data):
            raise BadRecord(f"a wrong length at {at}")
        yield at, size
        at += HEAD.size + size + TAIL.size


def label(data: bytes, at: int, size: int) -> tuple[int | None, int]:
    """The document id of the record at an offset, and its number of token ids."""
    there, doc_id, width = OWN.unpack_from(data, at + HEAD.size)
    return doc_id if there else None, (size - OWN.size) // width


def payload(data: bytes, at: int, size: int) -> tuple[int | None, np.ndarray]:
    """The document id and token ids of the record at an offset; its checksum is verified."""
    body = data[at + HEAD.size : at + HEAD.size + size]
    if TAIL.unpack_from(data, at + HEAD.size + size) != (masked(body), b"\n"):
        raise BadRecord(f"a wrong checksum at {at}")
    there, doc_id, width = OWN.unpack_from(body)
    return doc_id if there else None, np.frombuffer(body, f"<u{width}", offset=OWN.size)


def write_records(
    docs: DataFrame,
    folder: str,
    path: str,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_text: int = FILE_TEXT,
) -> None:
    """Encode the texts and write them below ``folder``: ``records/`` and then ``index/``.

    ``path`` is a tokenizer file that all machines have. Each document's ids end with
    ``end_id``; a null or empty text has that id alone. Records stand in ascending order
    of a long id, null ids first; rows with equal ids are put in order by a hash of the
    text. The texts are dealt to files by id; rows that share an id are spread by that
    hash and, if they are wholly equal, at random. Other columns are not looked at. An
    empty table gives a folder with an empty index.
    """
    spark = docs.sparkSession
    pattern, special, _ = settings(path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    order = ["id", "tie", "chance"]
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .withColumn("chance", F.rand(1))
        .repartitionByRange(-(-total // file_text) or 1, *order)
        .sortWithinPartitions(*order)
    )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = library_tokenizer(path)
        end = np.array([end_id], coder.dtype)
        try:
            for batch in batches:
                for first, _, lists in piece_lists(batch, coder.split):
                    offsets, ids = join_ids(lists, coder.cache)
                    names = batch.column("id").slice(first, len(lists)).to_pylist()
                    frames = [
                        frame(name, np.concatenate([ids[a:b], end]))
                        for name, a, b in zip(names, offsets[:-1], offsets[1:], strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["frame"])
        finally:
            coder.forget()

    frames = split_texts(ordered, "id", "text", pattern, special).mapInArrow(compute, "frame binary")
    # The cast hands the bytes on as they are.
    lines = frames.select(F.col("frame").cast("string").alias("value"))
    with small_batches(spark):
        lines.write.text(f"{folder}/records", lineSep="\n")
    write_index(spark, folder)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, content) of each record file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/records")
    return files.select(F.regexp_extract("path", r"part-(\d+)", 1).cast("long").alias("file"), "content")


def write_index(spark: SparkSession, folder: str) -> None:
    """The offset index of the records: file, row, offset, length, doc_id, n_tokens, and ``before``, the ids before it in its file."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("file"), batch.column("content"), strict=True):
                data = content.as_py()
                rows, before = [], 0
                for row, (at, size) in enumerate(lengths(data)):
                    name, n = label(data, at, size)
                    rows.append((file.as_py(), row, at, size, name, n, before))
                    before += n
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                        ["file", "row", "offset", "length", "doc_id", "n_tokens", "before"],
                    )

    columns = "file long, row long, offset long, length long, doc_id long, n_tokens long, before long"
    _files(spark, folder).mapInArrow(scan, columns).write.parquet(f"{folder}/index")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The index with ``start``: the ids of all records before. Totals are added up by blocks of files, then over blocks."""
    index = spark.read.parquet(f"{folder}/index")
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("n")).withColumn("block", F.expr(f"file div {FILES_AT_ONCE}"))
    blocks = files.groupBy("block").agg(F.sum("n").alias("n"))
    block_start = F.coalesce(
        F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    blocks = blocks.select("block", block_start.alias("block_start"))
    in_block = F.coalesce(
        F.sum("n").over(Window.partitionBy("block").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    starts = files.withColumn("in_block", in_block).join(blocks, "block")
    starts = starts.select("file", (F.col("block_start") + F.col("in_block")).alias("file_start"))
    return index.join(starts, "file").select(
        "file", "row", "offset", "length", "doc_id", (F.col("file_start") + F.col("before")).alias("start"), "n_tokens"
    )


def read_records(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """The records as they stand in the files: file, row, doc_id, n_tokens, ids_crc32, and the ids if wanted.

    Lengths and checksums are verified; a file that does not match is an error.
    ``ids_crc32`` is the CRC-32 of the ids as little-endian 32-bit integers.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("file"), batch.column("content"), strict=True):
                data = content.as_py()
                found = [(payload(data, at, size)) for at, size in lengths(data)]
                if not found:
                    continue
                columns = [
                    pa.array([file.as_py()] * len(found), pa.int64()),
                    pa.array(range(len(found)), pa.int64()),
                    pa.array([name for name, _ in found], pa.int64()),
                    pa.array([len(ids) for _, ids in found], pa.int64()),
                    pa.array([zlib.crc32(ids.astype("<u4").tobytes()) for _, ids in found], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([ids.astype(np.int64) for _, ids in found], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["file", "row", "doc_id", "n_tokens", "ids_crc32", *["ids"] * with_ids]
    schema = "file long, row long, doc_id long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return _files(spark, folder).mapInArrow(scan, schema)


def read_shuffled(spark: SparkSession, folder: str, wanted: DataFrame | None = None, seed: int = 0) -> DataFrame:
    """Records (doc_id, ids) in an order shuffled by the seed, found through the index.

    ``wanted`` holds rows of the index; all are read without it. Each file is read by one
    task, which takes the records at the wanted offsets.
    """
    index = spark.read.parquet(f"{folder}/index") if wanted is None else wanted
    offsets = index.groupBy("file").agg(F.collect_list(F.struct("offset", "length")).alias("places"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, places, sizes in zip(*batch.columns, strict=True):
                data = content.as_py()
                found = [payload(data, at, size) for at, size in zip(places.as_py(), sizes.as_py(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name for name, _ in found], pa.int64()),
                        pa.array([ids.astype(np.int64) for _, ids in found], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "ids"],
                )

    files = _files(spark, folder).join(offsets, "file").select("content", "places.offset", "places.length")
    picked = files.mapInArrow(pick, "doc_id long, ids array<long>")
    return picked.orderBy(F.xxhash64(F.lit(seed), "doc_id", "ids"))
