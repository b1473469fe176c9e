"""Byte-level BPE encoding and decoding by recursive queries.

Texts are split by the tokenizer's pattern in Spark. In each task, DuckDB encodes the
distinct pieces: a piece that is a token is taken as it is; any other starts as one row
per byte, and a recursive query joins neighbouring rows with the merge table and
contracts each piece's leftmost pair of least rank until no pair is left. Decoding joins
ids with the vocabulary and concatenates them by an ordered aggregation.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareweave.llm import duck
from fareweave.llm.words import PieceIds, free_memory, join_ids, piece_lists, split_texts

LONG_PIECE = 64  # bytes
SQUARES_AT_ONCE = 4_000_000  # ENCODE_LONG holds all steps: at most half the squares of the lengths in rows
ROWS_AT_ONCE = 120_000  # bytes of pieces, or tokens of texts, in one query

# One contraction for each piece and step. A row knows its right neighbour; of a piece's
# pairs, one number orders rank, place and the neighbour's place (both below 256).
ENCODE = """
WITH RECURSIVE step(n, piece, pos, id, next_pos, next_id) AS (
  SELECT 0::UTINYINT, piece, pos, id, next_pos, next_id FROM symbols
  UNION ALL
  SELECT r.n + 1::UTINYINT, r.piece, r.pos, CASE WHEN r.pos = best.pos THEN best.id ELSE r.id END,
         CASE WHEN r.pos = best.pos THEN best.after_pos ELSE r.next_pos END,
         CASE WHEN r.pos = best.pos THEN best.after_id WHEN r.next_pos = best.pos THEN best.id ELSE r.next_id END
  FROM step r JOIN (
    SELECT x.piece, x.pos, x.next_pos, x.id, y.next_pos AS after_pos, y.next_id AS after_id
    FROM (
      SELECT piece, (k // 65536)::INTEGER AS id, (k // 256 % 256)::INTEGER AS pos, (k % 256)::INTEGER AS next_pos
      FROM (
        SELECT piece, min(m.id::BIGINT * 65536 + pos * 256 + next_pos) AS k
        FROM step JOIN merges m ON m.lhs = step.id AND m.rhs = step.next_id
        GROUP BY piece)) x
    JOIN step y ON y.piece = x.piece AND y.pos = x.next_pos) best USING (piece)
  WHERE r.pos <> best.next_pos)
SELECT piece, id
FROM step JOIN (SELECT piece, max(n) AS n FROM step GROUP BY piece) USING (piece, n)
ORDER BY piece, pos
"""

# For long pieces, all contractions of a piece's least rank in one step. Of pairs that
# overlap, as in a run of one character, every second one counts from the left. In a
# vocabulary whose tokens are all reached by merges of lower rank, no merge makes a pair
# of lower rank than its own, so this is the order of the one-by-one query.
ENCODE_LONG = """
WITH RECURSIVE step(n, piece, pos, id, next_id, next_at) AS (
  SELECT 0, piece, pos, id, lead(id) OVER w, lead(pos) OVER w FROM symbols WINDOW w AS (PARTITION BY piece ORDER BY pos)
  UNION ALL
  SELECT n + 1, piece, pos, id, lead(id) OVER w, lead(pos) OVER w FROM (
    SELECT n, piece, pos, id, lag(taken, 1, false) OVER w AS gone FROM (
      SELECT n, piece, pos, taken, CASE WHEN taken THEN best ELSE id END AS id FROM (
        SELECT n, piece, pos, id, best,
               hit AND ((pos - max(CASE WHEN fresh THEN pos END) OVER w) // (next_at - pos)) % 2 = 0 AS taken
        FROM (
          SELECT *, hit AND NOT lag(hit, 1, false) OVER w AS fresh FROM (
            SELECT s.n, s.piece, s.pos, s.id, s.next_at, best.id AS best, coalesce(m.id = best.id, false) AS hit
            FROM step s
            JOIN (SELECT piece, min(m.id) AS id
                  FROM step JOIN merges m ON m.lhs = step.id AND m.rhs = step.next_id GROUP BY piece) best
              USING (piece)
            LEFT JOIN merges m ON m.lhs = s.id AND m.rhs = s.next_id)
          WINDOW w AS (PARTITION BY piece ORDER BY pos))
        WINDOW w AS (PARTITION BY piece ORDER BY pos)))
    WINDOW w AS (PARTITION BY piece ORDER BY pos))
  WHERE NOT gone
  WINDOW w AS (PARTITION BY piece ORDER BY pos))
SELECT piece, id
FROM (SELECT piece, pos, id FROM step QUALIFY n = max(n) OVER (PARTITION BY piece))
ORDER BY piece, pos
"""

# The same for pieces of any length, by statements over a table that keeps the newest step
# alone: a symbol that is joined to its left neighbour goes, and only the symbols beside a
# contraction change. ``merged`` is the rank of a symbol and its right neighbour.
LONG_START = """
CREATE OR REPLACE TEMP TABLE step AS
SELECT s.piece, s.pos, s.id, s.next_pos, lag(s.pos) OVER (PARTITION BY s.piece ORDER BY s.pos) AS prev_pos,
       m.id AS merged, s.piece::BIGINT * 4294967296 + s.pos AS key
FROM symbols s LEFT JOIN merges m ON m.lhs = s.id AND m.rhs = s.next_id
"""
LONG_TAKEN = """
CREATE OR REPLACE TEMP TABLE taken AS
WITH hit AS (
  SELECT s.* FROM step s JOIN (SELECT piece, min(merged) AS merged FROM step GROUP BY piece) USING (piece, merged)),
run AS (
  SELECT *, CASE WHEN lag(next_pos) OVER w IS DISTINCT FROM pos THEN row_number() OVER w END AS fresh,
         row_number() OVER w AS number
  FROM hit WINDOW w AS (PARTITION BY piece ORDER BY pos))
SELECT piece, pos, key, merged AS id, next_pos AS gone
FROM (SELECT *, number - max(fresh) OVER (PARTITION BY piece ORDER BY pos) AS place FROM run)
WHERE place % 2 = 0
"""
LONG_STEP = [
    # What stands after a pair, before the pair's second symbol goes.
    """CREATE OR REPLACE TEMP TABLE joined AS
       SELECT t.key, t.id, t.piece, t.pos, g.key AS gone_key, g.next_pos, s.prev_pos
       FROM taken t JOIN step g ON g.key = t.piece::BIGINT * 4294967296 + t.gone JOIN step s ON s.key = t.key""",
    "UPDATE step SET id = j.id, next_pos = j.next_pos FROM joined j WHERE step.key = j.key",
    "UPDATE step SET id = NULL, merged = NULL FROM joined j WHERE step.key = j.gone_key",
    """UPDATE step SET prev_pos = j.pos FROM joined j
       WHERE j.next_pos IS NOT NULL AND step.key = j.piece::BIGINT * 4294967296 + j.next_pos""",
    """CREATE OR REPLACE TEMP TABLE changed AS
       SELECT l.key, m.id AS merged
       FROM (SELECT key FROM joined UNION
             SELECT s.piece::BIGINT * 4294967296 + s.prev_pos FROM step s JOIN joined j ON s.key = j.key
             WHERE s.prev_pos IS NOT NULL) c
       JOIN step l ON l.key = c.key
       LEFT JOIN step n ON n.key = l.piece::BIGINT * 4294967296 + l.next_pos
       LEFT JOIN merges m ON m.lhs = l.id AND m.rhs = n.id""",
    "UPDATE step SET merged = c.merged FROM changed c WHERE step.key = c.key",
]
ENCODE_LONGEST = "SELECT piece, id FROM step WHERE id IS NOT NULL ORDER BY piece, pos"

DECODE = """
SELECT doc, unhex(string_agg(hex, '' ORDER BY pos)) AS bytes
FROM tokens JOIN vocabulary USING (id) GROUP BY doc ORDER BY doc
"""


class RankTokenizer:
    """A vocabulary of byte strings with ranks, which are also the ids. Made anew in each worker from its file."""

    def __init__(self, path: str, pattern: str):
        self.path, self.pattern = path, regex.compile(pattern)
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(t): int(r) for t, r in (x.split() for x in lines if x.strip())}
        self.cache = PieceIds(self.encode_pieces, np.int32)

    @cached_property
    def con(self):
        con = duck.connect()
        ranks = self.ranks
        merges = [
            (ranks[token[:cut]], ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        first, second, rank = (pa.array(c, pa.int32()) for c in zip(*merges, strict=True)) if merges else [[]] * 3
        con.register("given", pa.table({"lhs": first, "rhs": second, "id": rank}))
        con.execute("CREATE TABLE merges AS SELECT * FROM given")
        con.unregister("given")
        con.register("given", pa.table({"id": list(ranks.values()), "hex": [t.hex() for t in ranks]}))
        con.execute("CREATE TABLE vocabulary AS SELECT id::INTEGER AS id, hex FROM given")
        con.unregister("given")
        return con

    def _contract(self, sql: str, words: list[bytes]) -> list[bytes]:
        """The ids of some pieces, by the recursive query over their bytes."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        piece = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        at = np.arange(len(piece), dtype=np.int32) - np.repeat(ends - lengths, lengths).astype(np.int32)
        single = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        ids = single[np.frombuffer(b"".join(words), np.uint8)]
        last = np.zeros(len(piece), dtype=bool)
        last[ends - 1] = True
        symbols = pa.table(
            {
                "piece": piece,
                "pos": at,
                "id": ids,
                "next_pos": pa.array(at + 1, mask=last),
                "next_id": pa.array(np.append(ids[1:], np.int32(0)), mask=last),
            }
        )
        if sql is ENCODE_LONGEST:
            self.con.register("symbols", symbols)
            self.con.execute(LONG_START)
            self.con.unregister("symbols")
            while self.con.execute(LONG_TAKEN).fetchone()[0]:
                for statement in LONG_STEP:
                    self.con.execute(statement)
        found = duck.query(self.con, sql, symbols=symbols)
        ids = found.column("id").to_numpy().astype(np.int32).tobytes()
        sizes = np.bincount(found.column("piece").to_numpy(), minlength=len(words))
        offsets = [0, *(4 * np.cumsum(sizes)).tolist()]
        return [ids[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]

    @staticmethod
    def _way(word: bytes) -> str:
        """The query for a piece of this length; all give the same ids."""
        return ENCODE if len(word) <= LONG_PIECE else ENCODE_LONG if len(word) ** 2 <= SQUARES_AT_ONCE else ENCODE_LONGEST

    def forget(self) -> None:
        """End of a task: drop the cache and the database."""
        self.cache.forget()
        if "con" in self.__dict__:
            self.__dict__.pop("con").close()
        free_memory()

    def encode_pieces(self, texts: list[str]) -> list[bytes]:
        """The ids of each piece, as 32-bit integers."""
        words = [t.encode() for t in texts]
        out: list[bytes | None] = [
            np.int32(self.ranks[w]).tobytes() if w in self.ranks else None if w else b"" for w in words
        ]
        todo = sorted((i for i, ids in enumerate(out) if ids is None), key=lambda i: len(words[i]))
        while todo:
            sql = self._way(words[todo[0]])
            taken, size, squares = 0, 0, 0
            while taken < len(todo) and (not taken or size + len(words[todo[taken]]) <= ROWS_AT_ONCE):
                length = len(words[todo[taken]])
                if self._way(words[todo[taken]]) is not sql or (sql is ENCODE_LONG and squares + length**2 > SQUARES_AT_ONCE):
                    break
                size += length
                squares += length**2
                taken += 1
            some, todo = todo[:taken], todo[taken:]
            for i, ids in zip(some, self._contract(sql, [words[i] for i in some]), strict=True):
                out[i] = ids
        return out

    def decode(self, offsets: np.ndarray, ids: np.ndarray) -> list[bytes]:
        """The bytes of each list of ids. Ids outside the vocabulary are an error."""
        out = [b""] * (len(offsets) - 1)
        first = 0
        while first < len(out):
            end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + ROWS_AT_ONCE, side="right")) - 1)
            part = ids[offsets[first] : offsets[end]]
            places = np.arange(len(part), dtype=np.int32)
            doc = np.repeat(np.arange(first, end, dtype=np.int32), np.diff(offsets[first : end + 1]))
            if len(part) and (part.min() < 0 or not np.isin(np.unique(part), list(self.ranks.values())).all()):
                raise ValueError("an id is not in the vocabulary")
            # A very long text is joined from the aggregates of its parts.
            for a in range(0, len(part), ROWS_AT_ONCE):
                tokens = pa.table(
                    {
                        "doc": doc[a : a + ROWS_AT_ONCE],
                        "pos": places[a : a + ROWS_AT_ONCE],
                        "id": part[a : a + ROWS_AT_ONCE].astype(np.int32),
                    }
                )
                found = duck.query(self.con, DECODE, tokens=tokens)
                for d, b in zip(found.column("doc").to_pylist(), found.column("bytes").to_pylist(), strict=True):
                    out[d] += b
            first = end
        return out


_LOADED: dict[tuple[str, str], RankTokenizer] = {}


def tokenizer(path: str, pattern: str) -> RankTokenizer:
    """The worker's tokenizer for a file and pattern."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = RankTokenizer(path, pattern)
    return _LOADED[path, pattern]


def _run(docs: DataFrame, path: str, pattern: str, id_col: str, text_col: str, decoded: bool) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    split = split_texts(docs, id_col, text_col, pattern)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(path, pattern)
        try:
            for batch in batches:
                for first, end, lists in piece_lists(batch, coder.pattern.findall):
                    offsets, ids = join_ids(lists, coder.cache)
                    columns = [
                        batch.column("id").slice(first, end - first),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())),
                    ]
                    if decoded:
                        columns.append(pa.array(coder.decode(offsets, ids), pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, ["id", "ids", "decoded"][: len(columns)])
        finally:
            coder.forget()

    schema = f"id {kind}, ids array<int>" + ", decoded binary" * decoded
    return split.mapInArrow(compute, schema).withColumnRenamed("id", id_col)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, ids) per row of ``docs``: the token ids of the whole text.

    ``path`` is a file of base64 tokens and ranks that all machines have, ``pattern`` the
    pattern that splits texts. No special tokens. Null and empty texts have no ids. Other
    columns of ``docs`` are not looked at. An empty table gives an empty table.
    """
    return _run(docs, path, pattern, id_col, text_col, False)


def encode_decode(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``encode`` with ``decoded``: the bytes that the ids decode to, in the same pass."""
    return _run(docs, path, pattern, id_col, text_col, True)


def decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its array of ids; a null array gives no bytes, a null id is an error."""
    columns = [c for c in encoded.columns if c != "decoded"]
    schema = encoded.select(*columns).schema
    names = [f"c{i}" for i in range(len(columns))]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(path, pattern)
        at = columns.index(ids_col)
        try:
            for batch in batches:
                lists = batch.column(at)
                sizes = lists.value_lengths().fill_null(0).to_numpy()
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                decoded = pa.array(coder.decode(offsets, ids), pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*names, "decoded"])
        finally:
            coder.forget()

    fields = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, schema.fields, strict=True))
    out = encoded.select(*[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)])
    out = out.mapInArrow(compute, f"{fields}, decoded binary")
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, columns, strict=True)], "decoded")
