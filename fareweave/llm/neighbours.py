"""Nearest neighbours by inner product, through tables of cross-polytope hashes.

A table turns unit vectors by fast Hadamard pseudo-rotations (random signs, then a Hadamard
transform, three times) and names each by its nearest signed axis, for several rotations in a
row. A query probes not its own bucket alone but every bucket whose penalty, the sum of squared
distances by which its axes fall short of the query's best ones, is within a radius. The
radius is measured: a sample of queries is compared with all rows, and the radius is the least
one within which the wanted share of their neighbours lies. Candidates are ranked by their exact
inner product.

Rows of a table are dealt by the first axes to units of bounded bytes; a unit too large for that
is cut by a hash of the id. Queries go to the units where a bucket may lie within the radius. A task
reads a unit's rows, then streams the queries past them.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fareweave.llm.embeddings import usable

TABLES = 2
BUCKET_ROWS = 256  # rows of a bucket, at about even filling
UNIT_BYTES = 48 << 20  # of vectors that a task holds at once
LEAST_UNITS = 8  # of a table, so that a small one keeps several tasks busy
MOST_PREFIXES = 1 << 14
AUDITED = 256  # queries that are compared with all rows
WANTED_RECALL = 0.96
QUERY_ROWS, SLICE_ROWS, PAIRS = 512, 2048, 1 << 20  # queries, rows and pairs that are compared at once
ROUNDING = 1e-12  # of |q||x|: what a product of matrices may differ from a sum in order

LOG = logging.getLogger(__name__)


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, scaled to keep lengths; the width is a power of two."""
    n, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(n, width // (2 * half), 2, half)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2)
        half *= 2
    return x.reshape(n, width) / np.sqrt(width)


def unit_rows(x: np.ndarray) -> np.ndarray:
    # The largest entry first, so that squares of tiny or huge ones stay finite.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@dataclass(frozen=True)
class Index:
    """The hashes of all tables for vectors of one width."""

    width: int
    axes: tuple[int, ...]  # of each hash, how many axes count; a code has twice as many values
    units: int  # of a table, without cuts
    signs: np.ndarray  # tables x hashes x 3 x padded width
    lead: int  # hashes that say to which unit a row goes

    @classmethod
    def of(cls, rows: int, width: int, row_bytes: int, tables: int, seed: int) -> Index:
        padded = 1 << (width - 1).bit_length()
        axes, left = [], max(2, rows // BUCKET_ROWS)
        while left > 1:
            axes.append(min(padded, max(1, (1 << (left.bit_length() - 1)) // 2)))
            left //= 2 * axes[-1]
        units = max(LEAST_UNITS, -(-rows * row_bytes // UNIT_BYTES))
        lead, prefixes = 1, 2 * axes[0]
        while lead < len(axes) and prefixes < 4 * units and prefixes * 2 * axes[lead] <= MOST_PREFIXES:
            prefixes *= 2 * axes[lead]
            lead += 1
        signs = np.random.default_rng(seed).choice([-1.0, 1.0], size=(tables, len(axes), 3, padded))
        return cls(width, tuple(axes), min(units, prefixes), signs, lead)

    @property
    def tables(self) -> int:
        return len(self.signs)

    def turned(self, unit: np.ndarray, table: int) -> list[np.ndarray]:
        """The coordinates that count, for each hash of a table."""
        padded = np.zeros((len(unit), self.signs.shape[-1]))
        padded[:, : self.width] = unit
        out = []
        for signs, axes in zip(self.signs[table], self.axes, strict=True):
            x = padded
            for sign in signs:
                x = hadamard(x * sign)
            out.append(x[:, :axes])
        return out

    def codes(self, unit: np.ndarray, table: int) -> np.ndarray:
        """The nearest signed axis by each hash: twice the axis, plus one on its negative side."""
        found = []
        for x in self.turned(unit, table):
            axis = np.abs(x).argmax(axis=1)
            found.append(2 * axis + (x[np.arange(len(x)), axis] < 0))
        return np.stack(found, axis=1)

    def penalties(self, unit: np.ndarray, table: int) -> list[np.ndarray]:
        """For each hash, what each of its codes costs each query."""
        out = []
        for x in self.turned(unit, table):
            signed = np.stack([x, -x], axis=2).reshape(len(x), 2 * x.shape[1])
            out.append((signed.max(axis=1, keepdims=True, initial=0.0) - signed) ** 2)
        return out

    def prefix(self, codes: np.ndarray) -> np.ndarray:
        number = np.zeros(len(codes), dtype=np.int64)
        for h in range(self.lead):
            number = number * (2 * self.axes[h]) + codes[:, h]
        return number

    def least_by_unit(self, unit: np.ndarray, table: int) -> np.ndarray:
        """For each query and unit, the least that a bucket of the unit can cost."""
        costs = self.penalties(unit, table)
        total = costs[0]
        for more in costs[1 : self.lead]:
            total = (total[:, :, None] + more[:, None, :]).reshape(len(unit), total.shape[1] * more.shape[1])
        missing = -total.shape[1] % self.units
        total = np.pad(total, ((0, 0), (0, missing)), constant_values=np.inf)
        return total.reshape(len(unit), total.shape[1] // self.units, self.units).min(axis=1)


def best_first(query: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of each query's best scores, best first, ties to smaller ids."""
    order = np.lexsort((ids, -score, query))
    starts = np.flatnonzero(np.r_[True, query[order][1:] != query[order][:-1]])
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[rank < most]


class Best:
    """The best rows for each of a block of queries."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, most: int) -> None:
        self.ids, self.queries, self.most = query_ids, queries, most
        self.lengths = np.abs(queries).max(axis=1) * np.sqrt(queries.shape[1])
        self.top = np.full((len(queries), most), -np.inf)  # the best scores so far, in no order
        self.query, self.rows, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def look(self, which: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Compare the queries numbered ``which`` with rows, leaving out rows of a query's own id."""
        scores = self.queries[which] @ vectors.T
        scores[self.ids[which][:, None] == ids[None, :]] = -np.inf
        scores[np.isnan(scores)] = -np.inf
        both = np.concatenate([self.top[which], scores], axis=1)
        self.top[which] = np.partition(both, both.shape[1] - self.most, axis=1)[:, -self.most :]
        slack = ROUNDING * self.lengths[which] * np.abs(vectors).max(initial=0) * np.sqrt(vectors.shape[1])
        least = self.top[which].min(axis=1) - slack
        q, r = np.nonzero((scores >= least[:, None]) & (scores > -np.inf))
        # In order of the entries, whatever the block: equal vectors get equal scores.
        exact = (self.queries[which[q]] * vectors[r]).sum(axis=1)
        self.query = np.concatenate([self.query, which[q]])
        self.rows, self.score = np.concatenate([self.rows, ids[r]]), np.concatenate([self.score, exact])
        if len(self.query) > PAIRS:
            self.settle()

    def settle(self) -> None:
        keep = best_first(self.query, self.score, self.rows, self.most)
        self.query, self.rows, self.score = self.query[keep], self.rows[keep], self.score[keep]


def _vectors(batch: pa.RecordBatch, width: int, dtype: str) -> np.ndarray:
    """The packed vectors of a batch, without a copy where nothing lies between them."""
    column = batch.column("vector")
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(dtype).reshape(-1, width)


def _packed(rows: DataFrame, vector_col: str, dtype: str) -> DataFrame:
    """(id, vector, is_query): vectors as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("list")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(dtype).tobytes()
            size = len(flat) // max(1, len(lists))
            offsets = pa.py_buffer((np.arange(len(lists) + 1) * size).astype(np.int32))
            packed = pa.Array.from_buffers(pa.binary(), len(lists), [None, offsets, pa.py_buffer(flat)])
            yield pa.RecordBatch.from_arrays([batch.column("id"), packed, batch.column("is_query")], names=["id", "vector", "is_query"])

    return rows.select("id", F.col(vector_col).alias("list"), "is_query").mapInArrow(run, "id long, vector binary, is_query boolean")


def _radius(packed: DataFrame, index: Index, dtype: str, most: int, wanted: float) -> float:
    """The least radius within which the wanted share of the neighbours of sampled queries lies."""
    sample = packed.where("is_query").orderBy(F.xxhash64("id"), "id").limit(AUDITED).collect()
    if not sample:
        return 0.0
    ids = np.array([r.id for r in sample], dtype=np.int64)
    queries = np.frombuffer(b"".join(r.vector for r in sample), dtype).reshape(-1, index.width).astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, seen = Best(ids, queries, most), {}
        every = np.arange(len(ids))
        costs = [index.penalties(unit_rows(queries), t) for t in range(index.tables)]
        for batch in batches:
            x, found = _vectors(batch, index.width, dtype).astype(np.float64), batch.column("id").to_numpy()
            for at in range(0, len(x), SLICE_ROWS):
                best.look(every, found[at : at + SLICE_ROWS], x[at : at + SLICE_ROWS])
            best.settle()
            place = dict(zip(found.tolist(), range(len(found)), strict=True))
            seen = {i: v for i in set(best.rows.tolist()) if (v := x[place[i]] if i in place else seen[i]) is not None}
        if seen:
            names = np.array(sorted(seen))
            unit = unit_rows(np.stack([seen[i] for i in names.tolist()]))
            row, penalty = np.searchsorted(names, best.rows), np.full(len(best.rows), np.inf)
            for t in range(index.tables):
                codes = index.codes(unit, t)[row]
                penalty = np.minimum(penalty, sum(c[best.query, codes[:, h]] for h, c in enumerate(costs[t])))
            arrays = [pa.array(best.query), pa.array(best.rows), pa.array(best.score), pa.array(penalty)]
            yield pa.RecordBatch.from_arrays(arrays, names=["query", "row", "score", "penalty"])

    near = packed.select("id", "vector").mapInArrow(run, "query long, row long, score double, penalty double")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "row"))
    truth = near.withColumn("place", place).where(F.col("place") <= most).select("penalty").collect()
    penalties = np.sort([r.penalty for r in truth])
    if not len(penalties):
        return 0.0
    radius = float(penalties[int(np.ceil(wanted * len(penalties))) - 1])
    LOG.info("%d of %d audited neighbours within the radius %.4f", (penalties <= radius).sum(), len(penalties), radius)
    return radius


ENTRY = "unit long, kind int, id long, vector binary"
ROW, QUERY = 0, 1  # kinds, in the order in which a unit is read
CUTS = 20  # bits of a unit's number that count its cuts


def _dealt(packed: DataFrame, index: Index, dtype: str, radius: float, cuts: dict[tuple[int, int], int]) -> DataFrame:
    """Every row once for each table, and every query for each unit that it must look at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ways = np.ones((index.tables, index.units), dtype=np.int64)
        for (t, u), n in cuts.items():
            ways[t, u] = n
        for whole in batches:
            for at in range(0, whole.num_rows, QUERY_ROWS):
                batch = whole.slice(at, QUERY_ROWS)
                unit = unit_rows(_vectors(batch, index.width, dtype).astype(np.float64))
                salt = batch.column("salt").to_numpy()
                asks = np.flatnonzero(batch.column("is_query").to_numpy(zero_copy_only=False))
                places, units, kinds = [], [], []
                for t in range(index.tables):
                    group = index.prefix(index.codes(unit, t)) % index.units
                    places.append(np.arange(len(unit)))
                    units.append(((t * index.units + group) << CUTS) + salt % ways[t][group])
                    kinds.append(np.full(len(unit), ROW))
                    query, group = np.nonzero(index.least_by_unit(unit[asks], t) <= radius)
                    times = ways[t][group]
                    cut = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    places.append(np.repeat(asks[query], times))
                    units.append((np.repeat(t * index.units + group, times) << CUTS) + cut)
                    kinds.append(np.full(len(cut), QUERY))
                place = np.concatenate(places)
                for part in range(0, len(place), SLICE_ROWS):
                    taken = pa.array(place[part : part + SLICE_ROWS])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(units)[part : part + SLICE_ROWS]),
                            pa.array(np.concatenate(kinds)[part : part + SLICE_ROWS].astype(np.int32)),
                            batch.column("id").take(taken), batch.column("vector").take(taken),
                        ],
                        names=["unit", "kind", "id", "vector"],
                    )

    salted = packed.withColumn("salt", F.shiftrightunsigned(F.xxhash64("id", F.lit(7)), 1))
    return salted.mapInArrow(run, ENTRY)


def _cuts(packed: DataFrame, index: Index, dtype: str, row_bytes: int) -> dict[tuple[int, int], int]:
    """Into how many parts the units are cut that hold more bytes than a task should; others are absent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((index.tables, index.units), dtype=np.int64)
        for batch in batches:
            unit = unit_rows(_vectors(batch, index.width, dtype).astype(np.float64))
            for t in range(index.tables):
                group = index.prefix(index.codes(unit, t)) % index.units
                counts[t] += np.bincount(group, minlength=index.units)
        t, u = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(u), pa.array(counts[t, u])], names=["t", "u", "n"])

    limit = max(1, UNIT_BYTES // row_bytes)
    counted = packed.select("id", "vector").mapInArrow(run, "t long, u long, n long").groupBy("t", "u").agg(F.sum("n").alias("n"))
    return {(r.t, r.u): -(-r.n // limit) for r in counted.where(F.col("n") > limit).collect()}


def _once(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Which rows to keep so that rows equal in id and vector stand once."""
    keep = np.ones(len(ids), dtype=bool)
    order = np.argsort(ids, kind="stable")
    same = np.r_[ids[order][1:] == ids[order][:-1], False]
    seen = set()
    for i in order[same | np.r_[False, same[:-1]]].tolist():
        row = (int(ids[i]), vectors[i].tobytes())
        keep[i] = row not in seen
        seen.add(row)
    return keep


class _Unit:
    """The rows of a unit, ordered by bucket."""

    def __init__(self, index: Index, table: int, ids: np.ndarray, vectors: np.ndarray) -> None:
        keep = _once(ids, vectors)
        if not keep.all():
            ids, vectors = ids[keep], vectors[keep]
        codes = np.concatenate(
            [index.codes(unit_rows(vectors[i : i + SLICE_ROWS].astype(np.float64)), table) for i in range(0, len(ids), SLICE_ROWS)]
        )
        order = np.lexsort(codes.T[::-1])
        codes = codes[order]
        self.ids, self.vectors = ids[order], vectors[order]
        new = np.r_[True, (codes[1:] != codes[:-1]).any(axis=1)]
        self.starts = np.flatnonzero(new)
        self.ends = np.r_[self.starts[1:], len(ids)]
        self.codes = codes[self.starts]
        self.index, self.table = index, table

    def search(self, ids: np.ndarray, queries: np.ndarray, radius: float, most: int) -> Best:
        best = Best(ids, queries, most)
        costs = self.index.penalties(unit_rows(queries), self.table)
        near = sum(c[:, self.codes[:, h]] for h, c in enumerate(costs)) <= radius
        for b in np.flatnonzero(near.any(axis=0)):
            which = np.flatnonzero(near[:, b])
            for at in range(self.starts[b], self.ends[b], SLICE_ROWS):
                end = min(at + SLICE_ROWS, self.ends[b])
                best.look(which, self.ids[at:end], self.vectors[at:end].astype(np.float64))
        best.settle()
        return best


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(unit, kind, rows) for rows in a row that share both."""
    units, kinds = batch.column("unit").to_numpy(), batch.column("kind").to_numpy()
    starts = np.flatnonzero(np.r_[True, (units[1:] != units[:-1]) | (kinds[1:] != kinds[:-1])]).tolist()
    for a, b in zip(starts, [*starts[1:], len(units)], strict=True):
        yield int(units[a]), int(kinds[a]), batch.slice(a, b - a)


def _found(dealt: DataFrame, index: Index, dtype: str, radius: float, most: int) -> DataFrame:
    """(query_id, vec_id, score): the best of each unit for each query that looks at it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, vectors, built = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            for unit, kind, part in _runs(batch):
                if unit != now:
                    now, ids, vectors, built = unit, [], [], None
                x, names = _vectors(part, index.width, dtype), part.column("id").to_numpy()
                if kind == ROW:
                    ids.append(names.copy())
                    vectors.append(x.copy())
                elif ids or built:
                    if built is None:
                        table = (unit >> CUTS) // index.units
                        built = _Unit(index, table, np.concatenate(ids), np.concatenate(vectors))
                        ids, vectors = [], []
                    for at in range(0, len(names), QUERY_ROWS):
                        asked = names[at : at + QUERY_ROWS]
                        best = built.search(asked, x[at : at + QUERY_ROWS].astype(np.float64), radius, most)
                        arrays = [pa.array(asked[best.query]), pa.array(best.rows), pa.array(best.score)]
                        yield pa.RecordBatch.from_arrays(arrays, names=["query_id", "vec_id", "score"])

    return dealt.mapInArrow(run, "query_id long, vec_id long, score double")


def nearest(
    rows: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    most: int = 20,
    tables: int = TABLES,
    wanted_recall: float = WANTED_RECALL,
    seed: int = 42,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``is_query`` holds, the rows of largest inner product.

    Up to ``most`` rows each, best first, ties to the smaller id; ranks count from 1; scores are
    sums of products in double precision. Every usable row is in the index. The search is
    approximate: its radius takes in ``wanted_recall`` of the neighbours of up to 256 sampled
    queries, each compared with every row; there is no cap on buckets, probes or candidates.

    Ids are whole numbers; rows with a null id, and vectors that are null, zero or hold null or
    non-finite entries, take no part. A row whose id equals the query's is the query's own.
    Rows equal in id and vector are one candidate; rows of one id with different vectors are
    candidates each, and as queries one, which gets the best for any of them. Equal vectors of
    different ids are candidates each. Vectors only meet others of their width.
    A query without candidates has no row; an empty table gives an empty table. Other columns are ignored.
    """
    wide = isinstance(rows.schema[vector_col].dataType.elementType, T.DoubleType)
    dtype = "<f8" if wide else "<f4"
    kept = rows.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).cast("array<double>" if wide else "array<float>").alias("_v"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    sizes = kept.groupBy(F.size("_v").alias("width")).agg(F.count(F.lit(1)).alias("n")).collect()
    schema = "query_id long, vec_id long, score double"
    found = rows.sparkSession.createDataFrame([], schema)
    for width, n in sorted((r.width, r.n) for r in sizes):
        row_bytes = width * (8 if wide else 4)
        index = Index.of(n, width, row_bytes, tables, seed)
        packed = _packed(kept.where(F.size("_v") == width), "_v", dtype)
        radius = _radius(packed, index, dtype, most, wanted_recall)
        cuts = _cuts(packed, index, dtype, row_bytes)
        dealt = _dealt(packed, index, dtype, radius, cuts)
        parts = index.tables * index.units + sum(c - 1 for c in cuts.values())
        met = dealt.repartition(parts, "unit").sortWithinPartitions("unit", "kind")
        found = found.unionByName(_found(met, index, dtype, radius, most))
    # A candidate that several tables found stands there several times, with one score.
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= most)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
