"""Boosted regression trees from histograms, grown leaf by leaf or level by level.

Features are cut into bins once and stored, in blocks of rows that the executors then keep, in memory or on their
disks, with the margins of the trees so far. The bins of some features make up one code, and a table of codes is counted
for all of them at once. A round keeps the codes and residuals of its drawn rows; a pass over these adds up residuals per
(node, feature, bin), first inside each task, then across tasks; it counts the smaller child of every split, the larger one
is its parent minus that. Residuals are added as whole multiples of a power of two, so sums do not depend on the order of
the rows, differences are exact, and two fits give the same trees.

A tree's passes go down the levels, all nodes of a level at once. Which of the possible splits
a tree keeps is then decided best first: the leaf whose split gains most is split next, until the
wanted number of leaves stands. As gains do not depend on the order of splits, this gives the tree
that growing one leaf at a time gives, with a pass per level instead of a pass per leaf.

The result is a ``GBTRegressionModel``: it predicts in the JVM, saves and loads, and
names feature importances like any other Spark ML tree model.
"""

from __future__ import annotations

import functools
import heapq
import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, keyword_only
from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from fareweave import config
from fareweave.storage import delete_path, keep_checkpoints, scratch_path, spread

ID, TARGET, BINS = "_id", "_y", "_bins"
BLOCK = 1 << 16  # rows at least, and less than twice as many
CELLS = 1 << 12  # of a table that is counted for more than one feature
STORE_EVERY = 10  # trees between two writes of the margins
NODES_AT_ONCE = 64  # that a pass counts
TABLES_AT_ONCE = 32  # that the driver adds up; more are added up by tasks first
SUM_BITS = 60  # of a sum of residuals
# A residual's low bits, and above what a block of them adds up to a one to count it: doubles add up both without loss.
LOW, ONE = 18, 35
QUANTILE_ACCURACY = 10_000  # a cut point's rank is off by rows / this at most


@dataclass(frozen=True)
class TreeSettings:
    """What limits a tree and its rounds. ``leaves`` None: split all that gains, down to ``max_depth``.

    Features are drawn for each tree, or with ``by_node`` for each node. With ``first_whole`` there is no start value:
    the first tree fits the target itself and counts in full. Later trees fit the residuals times ``slope``; the squared
    error falls by twice the residual.
    """

    rounds: int = 150
    learning_rate: float = 0.1
    leaves: int | None = 31
    max_depth: int = 6
    min_leaf: int = 20
    min_split: int = 2
    min_gain: float = 0.0
    l2: float = 0.0
    row_share: float = 1.0
    column_share: float = 1.0
    bins: int = 255
    seed: int = config.SEED
    by_node: bool = False
    first_whole: bool = False
    slope: float = 1.0
    store_every: int = STORE_EVERY  # trees
    refuse_gaps: bool = False  # rows without a finite target are an error

    def rate(self, number: int) -> float:
        return 1.0 if self.first_whole and number == 0 else self.learning_rate

    def value(self, number: int, mean: float) -> float:
        """What a leaf of the tree of this number adds, before the rate."""
        return mean if self.first_whole and number == 0 else mean * self.slope

    def draw(self, random: np.random.Generator, columns: int) -> list[int]:
        drawn = max(1, math.ceil(self.column_share * columns))
        return sorted(random.choice(columns, size=drawn, replace=False).tolist())


@dataclass
class Node:
    """A node: its rows, the sum of their residuals, its split if it has one."""

    depth: int
    rows: int
    total: int  # of residuals, in units of 1 / scale
    value: float
    feature: int = -1
    bin: int = -1
    gain: float = 0.0
    left: int = -1
    right: int = -1


@dataclass(frozen=True)
class TreeArrays:
    """A tree as a task reads it. A node comes before its children."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def reach(
        self, below: Callable[[int, np.ndarray], np.ndarray], rows: np.ndarray, wanted: list[int] | None = None
    ) -> Iterator[tuple[int, np.ndarray]]:
        """(node, rows that come to it) for each leaf, or for each wanted node, none of them below another.

        ``below`` tells which of some rows go left at a node.
        """
        ends = self.left < 0
        if wanted is None:
            needed = np.ones(len(ends), dtype=bool)
        else:
            ends = np.zeros(len(ends), dtype=bool)
            ends[wanted] = True
            needed = ends.copy()
            for i in range(len(ends) - 1, -1, -1):
                needed[i] |= self.left[i] >= 0 and bool(needed[self.left[i]] or needed[self.right[i]])
        open_ = [(0, rows)]
        while open_:
            i, rows = open_.pop()
            if ends[i]:
                yield i, rows
            elif needed[i]:
                left = below(i, rows)
                if needed[self.right[i]]:
                    open_.append((self.right[i], rows[~left]))
                if needed[self.left[i]]:
                    open_.append((self.left[i], rows[left]))

    def walk(self, bins: np.ndarray) -> np.ndarray:
        """For each row of bins its leaf."""
        at = np.zeros(len(bins), dtype=np.int64)
        for leaf, rows in self.reach(lambda i, some: bins[some, self.feature[i]] <= self.cut[i], np.arange(len(bins))):
            at[rows] = leaf
        return at


@dataclass
class Tree:
    nodes: list[Node] = field(default_factory=list)

    def is_split(self, i: int) -> bool:
        return self.nodes[i].left >= 0

    def arrays(self) -> TreeArrays:
        columns = zip(*[(max(n.feature, 0), n.bin, n.left, n.right, n.value) for n in self.nodes], strict=True)
        return TreeArrays(*(np.array(c) for c in columns))


def cut_points(df: DataFrame, columns: list[str], bins: int) -> list[list[float]]:
    """For each column the values after which a bin ends: quantiles of the column, each value once, its largest left out.

    A column of few values, none of them rarer than one row in ``bins``, gets a bin for each value.
    """
    shares = [i / bins for i in range(1, bins)]
    asked = [
        F.percentile_approx(F.when(~F.isnan(c), F.col(c)), shares, QUANTILE_ACCURACY).alias(str(i))
        for i, c in enumerate(columns)
    ]
    largest = [F.max(F.when(~F.isnan(c), F.col(c))).alias(f"m{i}") for i, c in enumerate(columns)]
    row = df.agg(*asked, *largest).first()
    return [sorted({x for x in row[str(i)] or [] if x < row[f"m{i}"]}) for i in range(len(columns))]


@dataclass(frozen=True)
class Packing:
    """Features in groups: a code stands for one bin of each feature of its group.

    A group's codes are at most ``most``, or belong to one feature. ``widths``: bins by feature, that of missing values included.
    """

    widths: tuple[int, ...]
    most: int = CELLS

    @functools.cached_property
    def groups(self) -> list[list[int]]:
        groups: list[list[int]] = []
        for feature in sorted(range(len(self.widths)), key=lambda f: -self.widths[f]):
            room = (g for g in groups if self.cells(g) * self.widths[feature] <= self.most)
            group = next(room, None)
            if group is None:
                groups.append([feature])
            else:
                group.append(feature)
        return groups

    def cells(self, group: list[int]) -> int:
        return math.prod(self.widths[f] for f in group)

    @property
    def kind(self) -> type:
        most = max(map(self.cells, self.groups))
        return np.uint8 if most < 1 << 8 else np.uint16 if most <= 1 << 16 else np.uint32

    def codes(self, bins: list[np.ndarray]) -> np.ndarray:
        """Codes by group, of bins by feature."""
        out = np.zeros((len(self.groups), len(bins[0])), dtype=self.kind)
        for mine, group in zip(out, self.groups, strict=True):
            for feature in group:
                mine *= self.kind(self.widths[feature])
                mine += bins[feature].astype(self.kind)
        return out

    def router(self, tree: TreeArrays) -> Callable[[np.ndarray, int, np.ndarray], np.ndarray]:
        """Tells, given codes, which of some rows go left at a node."""
        tables = {}
        for i in np.flatnonzero(tree.left >= 0):
            feature = int(tree.feature[i])
            number = next(n for n, g in enumerate(self.groups) if feature in g)
            group = self.groups[number]
            after = self.cells(group[group.index(feature) + 1 :])
            left = np.zeros((self.cells(group) // after // self.widths[feature], self.widths[feature], after), dtype=bool)
            left[:, : tree.cut[i] + 1] = True
            tables[i] = number, left.ravel()

        def below(codes: np.ndarray, i: int, rows: np.ndarray) -> np.ndarray:
            number, left = tables[i]
            return left.take(codes[number] if len(rows) == codes.shape[1] else codes[number].take(rows))

        return below

    def tables(self, nodes: int) -> list[np.ndarray]:
        """For each group zeros: (nodes, 2, codes) of rows and residuals."""
        return [np.zeros((nodes, 2, self.cells(g)), dtype=np.int64) for g in self.groups]

    def add(self, tables: list[np.ndarray], node: int, codes: np.ndarray, residuals: np.ndarray) -> None:
        """Add rows and residuals of a node. Fewer than 2 * BLOCK rows."""
        high = (residuals >> LOW).astype(np.float64)
        low = ((residuals & ((1 << LOW) - 1)) | (1 << ONE)).astype(np.float64)
        for mine, table in zip(codes, tables, strict=True):
            cells, at = table.shape[2], mine.astype(np.intp)
            both = np.bincount(at, low, cells).astype(np.int64)
            table[node, 0] += both >> ONE
            table[node, 1] += (np.bincount(at, high, cells).astype(np.int64) << LOW) + (both & ((1 << ONE) - 1))

    def by_feature(self, tables: list[np.ndarray]) -> np.ndarray:
        """(nodes, features, 2, bins) of tables by group."""
        nodes = len(tables[0])
        out = np.zeros((nodes, len(self.widths), 2, max(self.widths)), dtype=np.int64)
        for table, group in zip(tables, self.groups, strict=True):
            for i, feature in enumerate(group):
                # What the features before this one add up to is taken off the front, one after the other.
                after = self.cells(group[i + 1 :])
                out[:, feature, :, : self.widths[feature]] = table.reshape(nodes, 2, self.widths[feature], after).sum(axis=3)
                table = table.reshape(nodes, 2, self.widths[feature], after).sum(axis=2)
        return out


class Drawn(NamedTuple):
    """The rows that a tree is fitted to: their codes by group, and their residuals in units of 1 / scale."""

    codes: np.ndarray
    residuals: np.ndarray


class Block(NamedTuple):
    """Some rows in arrays: their numbers, targets, the margins of the trees so far, their codes by group."""

    ids: np.ndarray
    target: np.ndarray
    margin: np.ndarray
    codes: np.ndarray

    def added(self, tree: TreeArrays, rate: float, router: Callable[[np.ndarray, int, np.ndarray], np.ndarray]) -> Block:
        margin = self.margin.copy()
        for leaf, rows in tree.reach(functools.partial(router, self.codes), np.arange(len(margin))):
            margin[rows] += rate * tree.value[leaf]
        return self._replace(margin=margin)

    def drawn(self, number: int, settings: TreeSettings, scale: float) -> Drawn:
        """The rows for the tree of this number."""
        residuals = np.floor((self.target - self.margin) * scale + 0.5).astype(np.int64)
        if settings.row_share >= 1:
            return Drawn(self.codes, residuals)
        lot = _hash(self.ids, settings.seed, number) & np.uint64((1 << 20) - 1)
        rows = np.flatnonzero(lot < round(settings.row_share * (1 << 20)))
        return Drawn(self.codes.take(rows, axis=1), residuals.take(rows))


def _hash(ids: np.ndarray, *numbers: int) -> np.ndarray:
    """Spark's ``xxhash64`` of a long and some ints, for many longs."""
    p1, p2, p3, p4, p5 = (
        np.uint64(p)
        for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
    )

    def turned(x: np.ndarray, n: int) -> np.ndarray:
        return (x << np.uint64(n)) | (x >> np.uint64(64 - n))

    def mixed(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(33))) * p2
        x = (x ^ (x >> np.uint64(29))) * p3
        return x ^ (x >> np.uint64(32))

    start = np.full(len(ids), 42, dtype=np.uint64) + p5 + np.uint64(8)
    out = mixed(turned(start ^ (turned(ids.astype(np.uint64) * p2, 31) * p1), 27) * p1 + p4)
    for number in numbers:
        own = np.full(len(ids), number & 0xFFFFFFFF, dtype=np.uint64) * p1
        out = mixed(turned((out + p5 + np.uint64(4)) ^ own, 23) * p2 + p3)
    return out


def _binned(df: DataFrame, columns: list[str], target: str, cuts: list[list[float]], packing: Packing) -> DataFrame:
    """Blocks of rows (ids, target, codes); a cut point belongs to the bin below it, missing values come last."""
    edges = [np.array(c) for c in cuts]

    def record(ids: np.ndarray, y: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
        packed = [pa.array([x.tobytes()], pa.binary()) for x in (ids, y, codes)]
        return pa.RecordBatch.from_arrays(packed, names=[ID, TARGET, BINS])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = []
            for i, edge in enumerate(edges):
                x = batch.column(f"x{i}").to_numpy(zero_copy_only=False)
                bins.append(np.where(np.isnan(x), len(edge) + 1, np.searchsorted(edge, x)))
            ids, y, codes = batch.column(ID).to_numpy(), batch.column(TARGET).to_numpy(), packing.codes(bins)
            for a in range(0, len(ids), BLOCK):
                yield record(ids[a : a + BLOCK], y[a : a + BLOCK], codes[:, a : a + BLOCK])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def block() -> pa.RecordBatch:
            whole = record(*(np.concatenate(c, axis=-1) for c in zip(*some, strict=True)))
            some.clear()
            return whole

        for batch in batches:
            for row in zip(*(batch.column(c) for c in (ID, TARGET, BINS)), strict=True):
                piece = _block([v.as_py() for v in row], 0.0, packing)
                some.append((piece.ids, piece.target, piece.codes))
                if sum(len(ids) for ids, _, _ in some) >= BLOCK:
                    yield block()
        if some:
            yield block()

    ready = [F.coalesce(F.col(c).cast("double"), F.lit(math.nan)).alias(f"x{i}") for i, c in enumerate(columns)]
    numbered = df.select(F.monotonically_increasing_id().alias(ID), F.col(target).cast("double").alias(TARGET), *ready)
    schema = f"{ID} binary, {TARGET} binary, {BINS} binary"
    return spread(numbered.mapInArrow(pieces, schema)).mapInArrow(joined, schema)


def _block(row: Row | list[bytes], base: float, packing: Packing) -> Block:
    ids, target = np.frombuffer(row[0], np.int64), np.frombuffer(row[1], np.float64)
    codes = np.frombuffer(row[2], packing.kind).reshape(len(packing.groups), -1)
    return Block(ids, target, np.full(len(ids), base), codes)


@dataclass(frozen=True)
class Rows:
    """The blocks with the margins of the trees so far, and of them the rows drawn for the next tree, kept by the executors."""

    blocks: RDD
    drawn: RDD
    settings: TreeSettings
    packing: Packing
    scale: float

    @staticmethod
    def of(stored: DataFrame, packing: Packing, base: float, settings: TreeSettings, scale: float) -> Rows:
        # As many blocks for each task, and no core without a task.
        cores, parts = stored.sparkSession.sparkContext.defaultParallelism, stored.rdd.getNumPartitions()
        even = stored.repartition(cores * max(1, round(parts / cores)))
        return Rows._kept(even.rdd.map(lambda row: _block(row, base, packing)), 0, settings, packing, scale)

    def added(self, tree: Tree, number: int) -> Rows:
        """With a further tree, and the rows drawn for the tree of this number."""
        arrays, rate, packing = tree.arrays(), self.settings.rate(number - 1), self.packing

        def run(blocks: Iterator[Block]) -> Iterator[Block]:
            router = packing.router(arrays)
            return (b.added(arrays, rate, router) for b in blocks)

        return Rows._kept(self.blocks.mapPartitions(run), number, self.settings, packing, self.scale)

    @staticmethod
    def _kept(blocks: RDD, number: int, settings: TreeSettings, packing: Packing, scale: float) -> Rows:
        blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
        drawn = blocks.map(lambda b: b.drawn(number, settings, scale)).persist(StorageLevel.MEMORY_AND_DISK)
        return Rows(blocks, drawn, settings, packing, scale)

    def forget(self) -> None:
        self.blocks.unpersist()
        self.drawn.unpersist()


@dataclass(frozen=True)
class Histograms:
    """Rows and residuals per (node, feature, bin), added up by tasks, then by Spark."""

    rows: Rows
    features: list[int]

    def count(self, tree: Tree, wanted: list[int]) -> dict[int, np.ndarray]:
        """For each wanted node: (features, bins, 2) of rows and residuals. A pass for so many nodes at once."""
        found: dict[int, np.ndarray] = {}
        for a in range(0, len(wanted), NODES_AT_ONCE):
            found |= self._pass(tree.arrays(), wanted[a : a + NODES_AT_ONCE])
        return found

    def _pass(self, arrays: TreeArrays, wanted: list[int]) -> dict[int, np.ndarray]:
        features, packing = self.features, self.rows.packing
        place = {node: i for i, node in enumerate(wanted)}

        def run(blocks: Iterator[Drawn]) -> Iterator[np.ndarray]:
            router, tables = packing.router(arrays), packing.tables(len(wanted))
            held: list[list[Drawn]] = [[] for _ in wanted]
            sizes = [0] * len(wanted)

            def add(i: int) -> None:
                codes, residuals = (np.concatenate(c, axis=-1) for c in zip(*held[i], strict=True))
                held[i].clear()
                sizes[i] = 0
                for a in range(0, len(residuals), BLOCK):
                    packing.add(tables, i, codes[:, a : a + BLOCK], residuals[a : a + BLOCK])

            for block in blocks:
                for node, rows in arrays.reach(functools.partial(router, block.codes), np.arange(len(block.residuals)), wanted):
                    i = place[node]
                    own = block if len(rows) == len(block.residuals) else Drawn(block.codes.take(rows, axis=1), block.residuals.take(rows))
                    held[i].append(own)
                    sizes[i] += len(rows)
                    # A table takes as long as some thousand rows: a node's rows are counted when they are many.
                    if sizes[i] >= BLOCK:
                        add(i)
            for i, size in enumerate(sizes):
                if size:
                    add(i)
            yield packing.by_feature(tables)[:, features]

        parts = self.rows.drawn.mapPartitions(run)
        found = parts.treeReduce(np.add, 1 if parts.getNumPartitions() <= TABLES_AT_ONCE else 2)
        return {node: found[i].transpose(0, 2, 1) for i, node in enumerate(wanted)}


def best_split(table: np.ndarray, settings: TreeSettings, scale: float) -> tuple[float, int, int] | None:
    """(gain, feature, bin) of the best split; of equal gains the first feature, then the lowest bin."""
    below = table.cumsum(axis=1)
    rows, total = below[0, -1]
    if rows < settings.min_split:
        return None
    n, g = below[:, :, 0], below[:, :, 1] / scale
    rest, all_ = rows - n, total / scale
    allowed = (n >= max(1, settings.min_leaf)) & (rest >= max(1, settings.min_leaf))
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = g * g / (n + settings.l2) + (all_ - g) * (all_ - g) / (rest + settings.l2) - all_ * all_ / (rows + settings.l2)
    gain = np.where(allowed, gain, -np.inf)
    feature, bin_ = np.unravel_index(int(gain.argmax()), gain.shape)
    if not gain[feature, bin_] > settings.min_gain:
        return None
    return float(gain[feature, bin_]), int(feature), int(bin_)


class Grower:
    """Grows the tree of a number."""

    def __init__(self, histograms: Histograms, number: int) -> None:
        self.histograms, self.settings, self.number = histograms, histograms.rows.settings, number
        self.features, self.scale = histograms.features, histograms.rows.scale
        self.full = Tree()  # every split that gains
        self.tables: dict[int, np.ndarray] = {}

    def grow(self) -> Tree:
        self.full.nodes.append(Node(0, 0, 0, 0.0))
        root = self.histograms.count(self.full, [0])
        rows, total = (int(v) for v in root[0][0].sum(axis=0))
        self.full.nodes[0] = Node(0, rows, total, self._value(rows, total))
        self.tables[0] = root[0]
        level = [0]
        while level:
            level = self._split_level(level)
        return self._best_first()

    def _value(self, rows: int, total: int) -> float:
        return self.settings.value(self.number, total / self.scale / (rows + self.settings.l2)) if rows else 0.0

    def _drawn(self, i: int) -> list[int]:
        """Places in ``features`` that a node may be split by."""
        if not self.settings.by_node:
            return list(range(len(self.features)))
        return self.settings.draw(np.random.default_rng([self.settings.seed, self.number, i]), len(self.features))

    def _split_level(self, level: list[int]) -> list[int]:
        """Split the nodes of a level that gain by it, and fill the tables of their children, if these may be split."""
        parents, counted = [], {}
        for i in level:
            node, mine = self.full.nodes[i], self._drawn(i)
            found = best_split(self.tables[i][mine], self.settings, self.scale)
            if found is None:
                continue
            node.gain, drawn, node.bin = found
            drawn = mine[drawn]
            node.feature = self.features[drawn]
            left = self.tables[i][:, : node.bin + 1][drawn].sum(axis=0)
            node.left, node.right = len(self.full.nodes), len(self.full.nodes) + 1
            for rows, total in (left, self.tables[i][drawn].sum(axis=0) - left):
                rows, total = int(rows), int(total)
                self.full.nodes.append(Node(node.depth + 1, rows, total, self._value(rows, total)))
            parents.append(i)
            counted[min(node.left, node.right, key=lambda c: self.full.nodes[c].rows)] = i
        # A split that loses to those known so far loses to them whatever lies below: its children need no table.
        kept = self._kept()
        parents = [i for i in parents if i in kept and self.full.nodes[i].depth + 1 < self.settings.max_depth]
        counted = {c: i for c, i in counted.items() if i in parents}
        if not counted:
            return []
        tables = self.histograms.count(self.full, list(counted))
        for child, parent in counted.items():
            node = self.full.nodes[parent]
            other = node.left + node.right - child
            self.tables[child] = tables[child]
            self.tables[other] = self.tables[parent] - tables[child]
        for i in parents:
            del self.tables[i]
        return [c for i in parents for c in (self.full.nodes[i].left, self.full.nodes[i].right)]

    def _kept(self) -> set[int]:
        """The nodes that are split if always the leaf that gains most is; of equal gains the one found first."""
        nodes, most = self.full.nodes, self.settings.leaves or len(self.full.nodes)
        queue = [(-nodes[0].gain, 0)] if self.full.is_split(0) else []
        kept: set[int] = set()
        while queue and len(kept) + 1 < most:
            _, i = heapq.heappop(queue)
            kept.add(i)
            for c in (nodes[i].left, nodes[i].right):
                if self.full.is_split(c):
                    heapq.heappush(queue, (-nodes[c].gain, c))
        return kept

    def _best_first(self) -> Tree:
        """The tree of the splits that are kept."""
        nodes, kept = self.full.nodes, self._kept()
        out = Tree()

        def copy(i: int) -> int:
            """Numbers in the order of reading: a node, all below its left child, all below its right."""
            old, at = nodes[i], len(out.nodes)
            out.nodes.append(Node(old.depth, old.rows, old.total, old.value))
            if i in kept:
                new = out.nodes[at]
                new.feature, new.bin, new.gain = old.feature, old.bin, old.gain
                new.left, new.right = copy(old.left), copy(old.right)
            return at

        copy(0)
        return out


@dataclass(frozen=True)
class Forest:
    """Trees in the order of their rounds, the start value, and the cut points that their bins stand for."""

    base: float
    trees: list[Tree]
    cuts: list[list[float]]
    scale: float

    def threshold(self, node: Node) -> float:
        return self.cuts[node.feature][node.bin]

    def rows(self) -> list[tuple]:
        """(tree, node, depth, feature, threshold, gain, rows, value); nodes number in the order of reading."""
        return [
            (
                t, i, n.depth, n.feature if tree.is_split(i) else None, self.threshold(n) if tree.is_split(i) else None,
                n.gain if tree.is_split(i) else None, n.rows, n.value,
            )
            for t, tree in enumerate(self.trees)
            for i, n in enumerate(tree.nodes)
        ]


NODES = "tree int, node int, depth int, feature int, threshold double, gain double, n_rows long, value double"


def fit_trees(df: DataFrame, columns: list[str], target: str, settings: TreeSettings) -> Forest:
    """Boost squared errors: each tree fits what the trees before it leave.

    Rows without a target take no part, unless they are refused. A missing feature value goes with the largest ones. Rows of a
    round are drawn by a hash of their number, features by a seeded draw; the numbers are given once,
    when the bins are stored. An empty table gives a start value of zero and no trees.

    The driver holds the histograms of one level: nodes x features x bins, whatever the number of rows.
    """
    spark = df.sparkSession
    keep_checkpoints(spark)
    is_known = F.col(target).isNotNull() & ~F.isnan(target)
    most = F.max(F.when(is_known, F.abs(target)))
    facts = df.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(is_known, 1)).alias("n"), most.alias("most")).first()
    if settings.refuse_gaps and (facts["rows"] > facts["n"] or facts["most"] == math.inf):
        raise ValueError(f"{target} must not be null, NaN or infinite")
    known = df.where(is_known)
    cuts = cut_points(known, columns, settings.bins)
    if not facts["n"]:
        return Forest(0.0, [], cuts, 1.0)
    # Whole multiples of 1/scale: n residuals of up to twice the largest target fit into a long.
    room = math.ceil(math.log2(2 * facts["most"])) if facts["most"] else 0
    scale = 2.0 ** (SUM_BITS - room - math.ceil(math.log2(facts["n"] + 1)))
    scale = min(scale, 2.0**40)
    base = 0.0 if settings.first_whole else known.agg(F.sum(F.floor(F.col(target) * F.lit(scale) + F.lit(0.5)).cast("long"))).first()[0] / scale / facts["n"]
    packing = Packing(tuple(len(c) + 2 for c in cuts))
    folders = [scratch_path(spark, "bins")]
    _binned(known, columns, target, cuts, packing).write.parquet(folders[0])
    rows = Rows.of(spark.read.parquet(folders[0]), packing, base, settings, scale)
    random = np.random.default_rng(settings.seed)
    trees: list[Tree] = []
    for number in range(settings.rounds):
        features = list(range(len(columns))) if settings.by_node else settings.draw(random, len(columns))
        before = rows
        if trees:
            rows = before.added(trees[-1], number)
            if settings.store_every > 0 and number % settings.store_every == 0:
                rows.blocks.checkpoint()
        trees.append(Grower(Histograms(rows, features), number).grow())
        if rows is not before:
            before.forget()
        if rows.blocks.isCheckpointed():
            folders.append(rows.blocks.getCheckpointFile())
            delete_path(spark, folders.pop(0))
    rows.forget()
    delete_path(spark, folders[0])
    return Forest(base, trees, cuts, scale)


STRUCT = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
    "gain: double, leftChild: int, rightChild: int, "
    "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def to_model(spark: SparkSession, forest: Forest, settings: TreeSettings, n_features: int, columns: dict[str, str]) -> GBTRegressionModel:
    """The trees as a Spark ML model, through the files that such a model is saved in: a start value is a tree of one leaf."""
    start = Tree([Node(0, forest.trees[0].nodes[0].rows if forest.trees else 0, 0, forest.base)])
    rows = []
    trees = forest.trees if settings.first_whole else [start, *forest.trees]
    for t, tree in enumerate(trees):
        for i, n in enumerate(tree.nodes):
            split = (n.feature, [forest.threshold(n)], -1) if tree.is_split(i) else (-1, [], -1)
            gain = n.gain / n.rows if tree.is_split(i) else -1.0
            stats = [float(n.rows), n.total / forest.scale, 0.0]
            rows.append((t, (i, n.value, 0.0, stats, n.rows, gain, n.left, n.right, split)))
    name = f"HistogramBoosting_{scratch_path(spark, 'model')[-12:]}"

    def header(kind: str, uid: str, extra: dict) -> str:
        kind = f"org.apache.spark.ml.regression.{kind}"
        about = {"class": kind, "timestamp": 0, "sparkVersion": spark.version, "uid": uid, "paramMap": columns, "defaultParamMap": {"impurity": "variance"}}
        return json.dumps({**about, **extra})

    weights = ([] if settings.first_whole else [1.0]) + [settings.rate(i) for i in range(len(forest.trees))]
    each = [(t, header("DecisionTreeRegressionModel", f"{name}_{t}", {}), w) for t, w in enumerate(weights)]
    whole = header("GBTRegressionModel", name, {"numFeatures": n_features, "numTrees": len(weights)})
    path = scratch_path(spark, "trees")
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(rows, STRUCT).coalesce(1).write.parquet(f"{path}/data")
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    model = GBTRegressionModel.load(path)
    delete_path(spark, path)
    return model


class HistogramBoosting(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """``fit_trees`` as a Spark ML estimator."""

    @keyword_only
    def __init__(self, *, settings: TreeSettings = TreeSettings()) -> None:
        super().__init__()
        self.settings = settings
        self.forest: Forest | None = None

    def setFeaturesCol(self, value: str) -> HistogramBoosting:
        return self._set(featuresCol=value)

    def setLabelCol(self, value: str) -> HistogramBoosting:
        return self._set(labelCol=value)

    def setPredictionCol(self, value: str) -> HistogramBoosting:
        return self._set(predictionCol=value)

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        vector = F.col(self.getFeaturesCol())
        first = dataset.select(F.size(vector_to_array(vector)).alias("n")).first()
        if first is None:
            raise ValueError("no rows to fit trees on")
        columns = [f"_x{i}" for i in range(first["n"])]
        parts = vector_to_array(vector)
        table = dataset.select(F.col(self.getLabelCol()).alias(TARGET), *[parts[i].alias(c) for i, c in enumerate(columns)])
        forest = fit_trees(table, columns, TARGET, self.settings)
        names = {"featuresCol": self.getFeaturesCol(), "labelCol": self.getLabelCol(), "predictionCol": self.getPredictionCol()}
        model = to_model(dataset.sparkSession, forest, self.settings, len(columns), names)
        return model
