"""A random forest of regression trees from histograms, many trees at once, level by level.

Features are cut into bins once; the executors keep the codes of the rows in arrays, and for each tree of a batch the place
of every drawn row: the node it has come to, and how often it was drawn. A level takes one pass: rows go on to their
children, and of each pair of children the smaller one is counted, as draws and targets per (node, feature, bin), inside
each task. A shuffle by tree brings a tree's tables together with those of the level before, the larger child is its
parent minus the smaller one, and the tasks that hold a tree's tables find its splits. The driver sees the splits alone.

Targets are added as whole multiples of a power of two, so sums do not depend on the order of the rows, and neither
batches nor the memory of a pass change a tree. Draws come from a hash of a row's number and the tree's.

The rules are those of Spark ML's forest: variance, all features at every node, Poisson draws, cut points halfway between
values; but cut points come from all rows, not from a sample. The result is a ``RandomForestRegressionModel``; its nodes
carry no impurity of their own.
"""

from __future__ import annotations

import functools
import json
import math
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, keyword_only
from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from fareweave import config
from fareweave.plans.boosting import Packing, _binned, _block
from fareweave.storage import delete_path, keep_checkpoints, scratch_path

TARGET = "_y"
CELLS = 1 << 6  # of a table that is counted for more than one feature: small, as there is one for each node
PASS_CELLS = 1 << 16  # of a table for all nodes that is counted for further features
ROWS = 1 << 21  # of a partition: its rows and their places are sent to and from a task as a whole
SLICE, SUMMED = 1 << 16, 1 << 21  # rows handled at once: at least, at most
VALUE_BITS = 31  # of a target; doubles add up SUMMED of them, drawn twice on average, without loss
SUM_BITS = 62
DRAW_BITS = 4  # of a place: how often the row was drawn; the others are its node's
KEPT_EVERY = 2  # levels between two places that rows are kept at: a step more takes as long as keeping and reading them
SUMMARY = 10_000  # values that a column's distribution is summed up by; few values are kept as they are
SUMMED_UP = 1 << 18  # rows summed up at once


@dataclass(frozen=True)
class ForestSettings:
    trees: int = 100
    max_depth: int = 12
    min_leaf: int = 5
    bootstrap: bool = True
    bins: int = 32
    memory_mb: int = 96  # of the tables of a pass, in each task, and of the rows' places
    seed: int = config.SEED


class Values(NamedTuple):
    """A column's distribution: values in order, and the rows that each stands for, those up to it; besides, rows without a value."""

    at: np.ndarray
    rows: np.ndarray
    missing: int

    @staticmethod
    def of(x: np.ndarray) -> Values:
        known = x[~np.isnan(x)]
        return Values.joined([Values(*np.unique(known, return_counts=True), len(x) - len(known))])

    @staticmethod
    def joined(some: list[Values]) -> Values:
        at, places = np.unique(np.concatenate([v.at for v in some]), return_inverse=True)
        rows = np.bincount(places, np.concatenate([v.rows for v in some]), len(at)).astype(np.int64)
        if len(at) > SUMMARY:
            below = rows.cumsum()
            kept = np.unique(np.searchsorted(below, below[-1] * np.arange(1, SUMMARY + 1) / SUMMARY))
            # The least value stays, and rounding must not lose the largest.
            kept = np.union1d(np.minimum(kept, len(at) - 1), [0, len(at) - 1])
            at, rows = at[kept], np.diff(below[kept], prepend=0)
        return Values(at, rows, sum(v.missing for v in some))

    def cuts(self, bins: int) -> list[float]:
        """Spark ML's cut points: between any two values if these are few, else where a share of the rows ends."""
        if len(self.at) <= bins:
            return [(float(a) + float(b)) / 2 for a, b in zip(self.at, self.at[1:])]
        stride = int(self.rows.sum()) / bins
        cuts, wanted, below = [], stride, int(self.rows[0])
        for i in range(1, len(self.at)):
            before, below = below, below + int(self.rows[i])
            if abs(before - wanted) < abs(below - wanted):
                cuts.append((float(self.at[i - 1]) + float(self.at[i])) / 2)
                wanted += stride
        return cuts


def distributions(df: DataFrame, columns: list[str]) -> list[Values]:
    """The distribution of each column, summed up in tasks. A rank is off by a few rows in ``SUMMARY``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Summaries of like size are joined, as digits are carried: each value is summed up a few times only.
        done: list[tuple[int, list[Values]]] = []
        waiting: list[pa.RecordBatch] = []

        def flush() -> None:
            whole = pa.Table.from_batches(waiting)
            waiting.clear()
            done.append((0, [Values.of(c.to_numpy()) for c in whole.columns]))
            while len(done) > 1 and done[-1][0] == done[-2][0]:
                (order, a), (_, b) = done.pop(), done.pop()
                done.append((order + 1, [Values.joined([*pair]) for pair in zip(a, b, strict=True)]))

        for batch in batches:
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= SUMMED_UP:
                flush()
        if waiting:
            flush()
        if done:
            whole = [Values.joined([*some]) for some in zip(*(v for _, v in done), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(whole)], pa.binary())], names=["values"])

    ready = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(math.nan)).alias(c) for c in columns])
    summed = ready.mapInArrow(run, "values binary").rdd.map(lambda row: pickle.loads(row[0]))
    return summed.treeReduce(lambda a, b: [Values.joined([*pair]) for pair in zip(a, b, strict=True)])


@dataclass(frozen=True)
class Layout:
    """How rows are coded, and where a feature's bins lie in a table's last axis."""

    widths: tuple[int, ...]

    @property
    def packing(self) -> Packing:
        return Packing(self.widths, CELLS)

    @property
    def starts(self) -> list[int]:
        return np.cumsum([0, *self.widths]).tolist()

    def columns(self, codes: np.ndarray, most: int) -> list[tuple[list[int], np.ndarray]]:
        """Groups of features and the rows' codes, groups joined as long as a table of them has no more cells than this."""
        packing = self.packing
        joined: list[tuple[list[int], np.ndarray]] = []
        for group, mine in zip(packing.groups, codes, strict=True):
            if joined and packing.cells(joined[-1][0] + group) <= min(most, 1 << 16):
                before, codes_before = joined.pop()
                group, mine = before + group, codes_before.astype(np.uint16) * np.uint16(packing.cells(group)) + mine
            joined.append((group, mine))
        return joined

    def by_feature(self, group: list[int], table: np.ndarray, out: np.ndarray) -> None:
        """Put tables (2, nodes and codes) of a group into (2, nodes, bins of all features)."""
        starts = self.starts
        table = table.reshape(*out.shape[:2], *[self.widths[f] for f in group])
        for i, f in enumerate(group):
            others = tuple(2 + j for j in range(len(group)) if j != i)
            out[:, :, starts[f] : starts[f + 1]] = table.sum(axis=others) if others else table


class Step(NamedTuple):
    """What a level does to the rows of a tree. Nodes of a level number from 1; 0 is the place of rows that have ended.

    The pairs of children that may be split have the numbers 1 and 2, 3 and 4 and so on; of pair i the right child is counted
    if ``right[i]``. The root is a pair of its own.
    """

    feature: np.ndarray  # by node of the level before, from 0; -1: not split
    bin: np.ndarray
    child: np.ndarray  # number of the left child, 0 if the children end here
    right: np.ndarray

    @property
    def parents(self) -> np.ndarray:
        """The nodes of the level before whose children go on."""
        return np.flatnonzero(self.child)


class Sample(NamedTuple):
    """The rows of a partition: targets, codes by group, and their places in each tree of a batch."""

    target: np.ndarray
    codes: np.ndarray
    places: list[np.ndarray]


@dataclass(frozen=True)
class Partition:
    ids: np.ndarray
    target: np.ndarray
    codes: np.ndarray

    @staticmethod
    def of(rows: Iterable[Row], packing: Packing, middle: float, scale: float) -> Partition:
        blocks = [_block(row, 0.0, packing) for row in rows]
        if not blocks:
            return Partition(np.zeros(0, np.int64), np.zeros(0), np.zeros((len(packing.groups), 0), packing.kind))
        ids, target, codes = (np.concatenate(c, axis=-1) for c in zip(*((b.ids, b.target, b.codes) for b in blocks), strict=True))
        return Partition(ids, np.floor((target - middle) * scale + 0.5), codes)

    def sample(self, trees: range, settings: ForestSettings) -> Sample:
        kind = np.uint16 if settings.max_depth <= 12 else np.uint32
        places = []
        for tree in trees:
            place = np.full(len(self.ids), (1 << DRAW_BITS) + 1, dtype=kind)
            if settings.bootstrap:
                for a in range(0, len(place), SLICE):
                    times = draws(self.ids[a : a + SLICE], settings.seed, tree)
                    place[a : a + SLICE] = np.where(times > 0, times + (1 << DRAW_BITS), 0)
            places.append(place)
        return Sample(self.target, self.codes, places)


# How often a row is drawn with replacement: Poisson's distribution of mean 1, in units of 2^-32. At most 12 times.
POISSON = np.floor(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(13)]) * 2.0**32).astype(np.uint64)
SURE = np.searchsorted(POISSON, np.arange(1 << 16, dtype=np.uint64) << np.uint64(16), side="right").astype(np.uint8)
UNSURE = np.isin(np.arange(1 << 16), (POISSON >> np.uint64(16)).astype(np.int64))


def draws(ids: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row is drawn for a tree."""
    start, odd = np.random.default_rng([seed, tree]).integers(1 << 63, size=2, dtype=np.uint64)
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + start
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9) + odd
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    lot = (x ^ (x >> np.uint64(31))) >> np.uint64(32)
    top = (lot >> np.uint64(16)).astype(np.intp)
    times = SURE.take(top)
    unsure = np.flatnonzero(UNSURE.take(top))
    times[unsure] = np.searchsorted(POISSON, lot[unsure], side="right")
    return times


def moved(sample: Sample, steps: list[Step], layout: Layout) -> Sample:
    """The rows at the children of the nodes where they were."""
    packing = layout.packing
    groups = packing.groups
    most, rows = max(map(packing.cells, groups)), len(sample.target)
    codes = sample.codes.ravel()
    number = {f: g for g, group in enumerate(groups) for f in group}
    # For each feature, and each code of its group, the bin.
    bins = np.zeros((len(layout.widths), most), dtype=np.int64)
    for f, g in number.items():
        group = groups[g]
        after = packing.cells(group[group.index(f) + 1 :])
        bins[f] = np.arange(most) // after % layout.widths[f]
    number = np.array([number[f] for f in range(len(layout.widths))])

    def go(place: np.ndarray, step: Step) -> np.ndarray:
        split = (step.feature >= 0) & (step.child > 0)
        feature = np.where(split, step.feature, 0)
        column = np.concatenate([[0], number[feature] * rows])
        # For each node and code the place that follows.
        following = np.where(bins[feature] <= step.bin[:, None], step.child[:, None], step.child[:, None] + 1)
        following[~split] = 0
        following = np.concatenate([np.zeros((1, most), np.int64), following]).astype(place.dtype).ravel() << DRAW_BITS
        out = np.zeros_like(place)
        for a in range(0, rows, SLICE):
            mine = place[a : a + SLICE]
            some = np.flatnonzero(mine >> DRAW_BITS)
            mine = mine.take(some)
            node = (mine >> DRAW_BITS).astype(np.intp)
            code = codes.take(column.take(node) + (some + a))
            out[some + a] = following.take(node * most + code) | (mine & ((1 << DRAW_BITS) - 1))
        return out

    return sample._replace(places=[go(p, s) if len(s.child) else np.zeros_like(p) for p, s in zip(sample.places, steps, strict=True)])


def counted(sample: Sample, steps: list[Step], first: int, layout: Layout, memory: int) -> Iterator[tuple[int, tuple]]:
    """For each tree tables of draws and targets by (pair, bin), of the children that are counted."""
    rows, bins = len(sample.target), layout.starts[-1]
    pairs = max((len(s.right) for s in steps), default=0)
    columns = layout.columns(sample.codes, PASS_CELLS // max(1, pairs))
    cells = [math.prod(layout.widths[f] for f in group) for group, _ in columns]
    at_once = max(1, memory // (16 * (bins + sum(cells))))
    for tree, (place, step) in enumerate(zip(sample.places, steps, strict=True), first):
        for first_pair in range(0, len(step.right), at_once):
            right = step.right[first_pair : first_pair + at_once]
            pair = np.full(2 * len(step.right) + 1, -1)
            pair[1 + 2 * (first_pair + np.arange(len(right))) + right] = np.arange(len(right))
            tables = [np.zeros((2, len(right) * c), dtype=np.int64) for c in cells]
            # Few rows stay in the processor's cache, many are worth a table.
            length = min(SUMMED, max(SLICE, 8 * len(right) * max(cells)))
            for a in range(0, rows, length):
                mine = place[a : a + length]
                at = pair.take(mine >> DRAW_BITS)
                some = np.flatnonzero(at >= 0)
                if not len(some):
                    continue
                at = at.take(some)
                times = (mine.take(some) & ((1 << DRAW_BITS) - 1)).astype(np.float64)
                values = times * sample.target[a : a + length].take(some)
                for (_, codes), size, table in zip(columns, cells, tables, strict=True):
                    key = at * size
                    key += codes[a : a + length].take(some)
                    for out, weights in zip(table, (times, values), strict=True):
                        out += np.bincount(key, weights, len(out)).astype(np.int64)
            both = np.empty((2, len(right), bins), dtype=np.int64)
            for (group, _), table in zip(columns, tables, strict=True):
                layout.by_feature(group, table, both)
            yield from sent(tree, first_pair, both[0].astype(np.int32), both[1])


def sent(tree: int, first_pair: int, draws_: np.ndarray, sums: np.ndarray) -> Iterator[tuple[int, tuple]]:
    """Tables as (tree, (first pair, cells that are not empty or None for all, draws, targets))."""
    filled = np.flatnonzero(draws_)
    if not len(filled):
        return
    if len(filled) * 2 < draws_.size:
        yield tree, (first_pair, filled.astype(np.int32), draws_.ravel()[filled], sums.ravel()[filled])
    else:
        yield tree, (first_pair, None, draws_, sums)


def gathered(records: Iterable[tuple[int, tuple | np.ndarray]], steps: dict[int, Step], layout: Layout) -> Iterator[tuple[int, np.ndarray]]:
    """Tables (2, nodes, bins) of the nodes of a level, by tree, from those counted and those of the level before."""
    bins = layout.starts[-1]
    parents: dict[int, np.ndarray] = {}
    found = {t: np.zeros((2, len(s.right), bins), dtype=np.int64) for t, s in steps.items() if len(s.right)}
    for tree, part in records:
        if isinstance(part, np.ndarray):
            if part.size:
                parents[tree] = part
            continue
        first_pair, filled, *both = part
        for table, own in zip(found[tree], both, strict=True):
            if filled is None:
                table[first_pair : first_pair + len(own)] += own
            else:
                table.ravel()[first_pair * bins + filled.astype(np.int64)] += own
    for tree, table in found.items():
        if tree in parents:
            step = steps[tree]
            both = np.empty((2, len(step.right), 2, bins), dtype=np.int64)
            pairs, right = np.arange(len(step.right)), step.right.astype(np.intp)
            both[:, pairs, right] = table
            both[:, pairs, 1 - right] = parents[tree] - table
            table = both.reshape(2, -1, bins)
        yield tree, table


class Splits(NamedTuple):
    """By node: draws, sum of targets, the best split's feature (-1: none), bin, gain, and the draws and sum on its left."""

    rows: np.ndarray
    total: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    gain: np.ndarray
    left_rows: np.ndarray
    left_total: np.ndarray


def best_splits(tables: np.ndarray, layout: Layout, min_leaf: int) -> Splits:
    """Of equal gains the first feature's, then the lowest bin's. What rounding may have left of a gain is none."""
    nodes, starts = tables.shape[1], layout.starts
    rows, total = (t[:, : layout.widths[0]].sum(axis=1) for t in tables)
    out = Splits(rows, total, np.full(nodes, -1), np.full(nodes, -1), np.zeros(nodes), np.zeros(nodes, np.int64), np.zeros(nodes, np.int64))
    least = max(1, min_leaf)
    for a in range(0, nodes, 256):
        here = slice(a, a + 256)
        n, s = rows[here, None], total[here, None]
        for f, width in enumerate(layout.widths):
            if width < 2:
                continue
            left, sums = (t[here, starts[f] : starts[f + 1] - 1].cumsum(axis=1) for t in tables)
            allowed = (left >= least) & (n - left >= least)
            if not allowed.any():
                continue
            share = s * (left / np.maximum(n, 1))
            off = sums - share
            allowed &= np.abs(off) > 2.0**-48 * (np.abs(sums) + np.abs(share))
            gain = np.where(allowed, off * off / np.maximum(left, 1) * (n / np.maximum(n - left, 1)), 0.0)
            best = gain.argmax(axis=1)
            each = np.arange(len(best))
            better = each[gain[each, best] > out.gain[here]]
            best = best[better]
            to = better + a
            out.feature[to], out.bin[to], out.gain[to] = f, best, gain[better, best]
            out.left_rows[to], out.left_total[to] = left[better, best], sums[better, best]
    return out


@dataclass
class Nodes:
    """The nodes of a tree in the order in which they were found, a level after the other."""

    feature: np.ndarray
    bin: np.ndarray
    gain: np.ndarray
    left: np.ndarray
    rows: np.ndarray
    total: np.ndarray

    @staticmethod
    def leaves(rows: np.ndarray, total: np.ndarray) -> Nodes:
        none = np.full(len(rows), -1)
        return Nodes(none.copy(), none.copy(), np.zeros(len(rows)), none.copy(), rows, total)

    @staticmethod
    def joined(some: list[Nodes]) -> Nodes:
        return Nodes(*(np.concatenate([getattr(n, c) for n in some]) for c in Nodes.__dataclass_fields__))


@dataclass
class Growing:
    """A tree on the driver: the nodes of its levels, and which of the last level's may be split."""

    levels: list[Nodes] = field(default_factory=list)
    open: np.ndarray = field(default_factory=lambda: np.zeros(1, np.intp))
    size: int = 1

    def grow(self, found: Splits, depth: int, settings: ForestSettings) -> Step:
        """Split the open nodes of the level of this depth; the step to the next level."""
        if depth == 0:
            self.levels.append(Nodes.leaves(found.rows, found.total))
        level, split = self.levels[-1], np.flatnonzero(found.feature >= 0)
        parents = self.open[split]
        level.feature[parents], level.bin[parents], level.gain[parents] = found.feature[split], found.bin[split], found.gain[split]
        level.left[parents] = self.size + 2 * np.arange(len(split))
        self.size += 2 * len(split)
        rows, total = (
            np.stack([left[split], all_[split] - left[split]], axis=1)
            for left, all_ in ((found.left_rows, found.rows), (found.left_total, found.total))
        )
        self.levels.append(Nodes.leaves(rows.ravel(), total.ravel()))
        # Children go on if one of them has rows for two leaves, and depth is left for a split.
        on = np.flatnonzero(rows.max(axis=1, initial=0) >= 2 * max(1, settings.min_leaf)) if depth + 1 < settings.max_depth else np.zeros(0, np.intp)
        self.open = (2 * on[:, None] + np.arange(2)).ravel()
        child = np.zeros(len(found.feature), dtype=np.int64)
        child[split[on]] = 1 + 2 * np.arange(len(on))
        return Step(found.feature, found.bin, child, rows[on, 1] < rows[on, 0])


ROOT = Step(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, dtype=bool))


@dataclass(frozen=True)
class Forest:
    trees: list[Nodes]
    cuts: list[list[float]]
    middle: float
    scale: float


def _batch(partitions: RDD, trees: range, layout: Layout, settings: ForestSettings) -> list[Nodes]:
    """Grow some trees together, a job a level."""
    first, memory = trees[0], settings.memory_mb << 20
    # A task that finds splits holds a few trees.
    tasks = min(len(trees), max(partitions.context.defaultParallelism, math.ceil(len(trees) / 4)))
    growing = {t: Growing() for t in trees}
    steps = {t: ROOT for t in trees}
    rows = partitions.map(lambda p: p.sample(trees, settings)).persist(StorageLevel.MEMORY_AND_DISK)
    path: list[list[Step]] = []  # from where the rows are kept
    tables: RDD | None = None
    for depth in range(max(1, settings.max_depth)):
        known, kept = dict(steps), [rows, tables]
        here = [known[t] for t in trees]
        if depth:
            path.append(here)

        def go(sample: Sample, path: list[list[Step]] = [*path]) -> Sample:
            return functools.reduce(lambda s, steps: moved(s, steps, layout), path, sample)

        def count(sample: Sample, steps: list[Step] = here) -> Iterator[tuple[int, tuple]]:
            return counted(sample, steps, first, layout, memory)

        now = rows.map(go) if path else rows
        if len(path) == KEPT_EVERY:
            rows = now = now.persist(StorageLevel.MEMORY_AND_DISK)
            path = []
        parts = now.flatMap(count)
        if tables is not None:
            parts = parts.union(tables.map(lambda pair, steps=known: (pair[0], pair[1][:, steps[pair[0]].parents])))
        dealt = parts.partitionBy(tasks, lambda t: (t - first) % tasks)

        def gather(task: int, records: Iterator, steps: dict[int, Step] = known) -> Iterator[tuple[int, np.ndarray]]:
            return gathered(records, {t: s for t, s in steps.items() if (t - first) % tasks == task}, layout)

        tables = dealt.mapPartitionsWithIndex(gather, preservesPartitioning=True)
        if depth + 1 < settings.max_depth:
            tables = tables.persist(StorageLevel.MEMORY_AND_DISK)
        found = dict(tables.mapValues(lambda t: best_splits(t, layout, settings.min_leaf if settings.max_depth else 1 << 62)).collect())
        for old in kept:
            if old is not None and old is not rows:  # read for the last time
                old.unpersist()
        none = Step(*(np.zeros(0, np.int64) for _ in Step._fields))
        steps = {t: growing[t].grow(found[t], depth, settings) if t in found else none for t in trees}
        if not any(len(s.right) for s in steps.values()):
            break
    rows.unpersist()
    tables.unpersist()
    return [Nodes.joined(growing[t].levels) for t in trees]


def fit_forest(df: DataFrame, columns: list[str], target: str, settings: ForestSettings) -> Forest:
    """Grow the trees, as many together as the memory of a pass allows for."""
    spark = df.sparkSession
    keep_checkpoints(spark)
    y = F.col(target).cast("double")
    is_known = y.isNotNull() & ~F.isnan(y) & (F.abs(y) < F.lit(math.inf))
    facts = df.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(is_known, 1)).alias("n"), F.min(y).alias("low"), F.max(y).alias("high")).first()
    if not facts["rows"]:
        raise ValueError("no rows to fit trees on")
    if facts["rows"] > facts["n"]:
        raise ValueError(f"{target} must not be null, NaN or infinite")
    n, middle = facts["n"], facts["low"] / 2 + facts["high"] / 2
    most = max(facts["high"] - middle, middle - facts["low"])
    bits = min(VALUE_BITS, SUM_BITS - math.ceil(math.log2(2 * n + 1)))
    scale = 2.0 ** min(1000, bits - math.ceil(math.log2(most))) if most else 1.0
    values = distributions(df, columns)
    cuts = [v.cuts(min(settings.bins, n)) for v in values]
    layout = Layout(tuple(len(c) + 1 + (v.missing > 0) for c, v in zip(cuts, values, strict=True)))
    packing, cores = layout.packing, spark.sparkContext.defaultParallelism
    folder = scratch_path(spark, "bins")
    _binned(df, columns, target, cuts, packing).write.parquet(folder)
    # As many partitions for each core, none of them large.
    parts = cores * math.ceil(n / (cores * ROWS))
    stored = spark.read.parquet(folder).repartition(parts).rdd
    partitions = stored.mapPartitions(lambda rows: [Partition.of(rows, packing, middle, scale)]).persist(StorageLevel.MEMORY_AND_DISK)
    # A task holds for each tree its rows' places, and a table of the deepest level, of which it sends the cells that it filled.
    own = math.ceil(n / parts)
    nodes = min(1 << max(0, min(settings.max_depth, 30) - 2), math.ceil(n / (2 * max(1, settings.min_leaf))))
    table = min(nodes * layout.starts[-1] * 12, own // 2 * len(columns) * 16)
    together = max(1, (settings.memory_mb << 20) // max(table, own * (2 if settings.max_depth <= 12 else 4)))
    batches = math.ceil(settings.trees / together)
    trees: list[Nodes] = []
    for i in range(batches):
        some = range(i * settings.trees // batches, (i + 1) * settings.trees // batches)
        trees += _batch(partitions, some, layout, settings)
    partitions.unpersist()
    delete_path(spark, folder)
    return Forest(trees, cuts, middle, scale)


def to_forest_model(
    spark: SparkSession, forest: Forest, settings: ForestSettings, n_features: int, columns: dict[str, str]
) -> RandomForestRegressionModel:
    """The trees as a Spark ML model, through the files that such a model is saved in."""
    path = scratch_path(spark, "trees")
    # Predictions are divided by the number of trees that is named here.
    params = {
        "numTrees": settings.trees, "maxDepth": settings.max_depth, "minInstancesPerNode": settings.min_leaf,
        "bootstrap": settings.bootstrap, "maxBins": settings.bins, "maxMemoryInMB": settings.memory_mb,
        "featureSubsetStrategy": "all", "seed": settings.seed, **columns,
    }
    name = f"HistogramForest_{path[-12:]}"

    def header(kind: str, uid: str, extra: dict) -> str:
        kind = f"org.apache.spark.ml.regression.{kind}"
        about = {"class": kind, "timestamp": 0, "sparkVersion": spark.version, "uid": uid, "defaultParamMap": {"impurity": "variance"}}
        return json.dumps({**about, **extra})

    thresholds = np.full((n_features, max(1, *map(len, forest.cuts))), np.nan)
    for f, cuts in enumerate(forest.cuts):
        thresholds[f, : len(cuts)] = cuts
    sizes = [len(t.rows) for t in forest.trees]
    ids = np.concatenate([np.arange(s) for s in sizes]).astype(np.int32)
    t = Nodes.joined(forest.trees)
    split, rows = t.feature >= 0, np.maximum(t.rows, 1)
    value = np.where(t.rows > 0, forest.middle + t.total / forest.scale / rows, 0.0)
    # In units of the target; the stats of a node are its rows, the sum of their targets, and no sum of squares.
    gain = np.where(split, t.gain / forest.scale / forest.scale / rows, -1.0)
    stats = np.stack([t.rows.astype(float), value * t.rows, np.zeros(len(rows))], axis=1)
    ends = pa.array(np.concatenate([[0], np.cumsum(split)]).astype(np.int32))
    three = pa.array((3 * np.arange(len(rows) + 1)).astype(np.int32))
    cut = pa.ListArray.from_arrays(ends, pa.array(thresholds[t.feature[split], t.bin[split]]))
    names = ["featureIndex", "leftCategoriesOrThreshold", "numCategories"]
    splits = pa.StructArray.from_arrays([pa.array(t.feature.astype(np.int32)), cut, pa.array(np.full(len(rows), -1, np.int32))], names)
    data = {
        "id": pa.array(ids), "prediction": pa.array(value), "impurity": pa.array(np.zeros(len(rows))),
        "impurityStats": pa.ListArray.from_arrays(three, pa.array(stats.ravel())), "rawCount": pa.array(t.rows.astype(np.int64)),
        "gain": pa.array(gain), "leftChild": pa.array(t.left.astype(np.int32)),
        "rightChild": pa.array(np.where(split, t.left + 1, -1).astype(np.int32)), "split": splits,
    }
    number = pa.array(np.repeat(np.arange(len(sizes)), sizes).astype(np.int32))
    nodes = pa.table({"treeID": number, "nodeData": pa.StructArray.from_arrays(list(data.values()), list(data))})
    each = [(i, header("DecisionTreeRegressionModel", f"{name}_{i}", {"paramMap": columns}), 1.0) for i in range(len(sizes))]
    whole = header("RandomForestRegressionModel", name, {"paramMap": params, "numFeatures": n_features, "numTrees": len(sizes)})
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(nodes).coalesce(1).write.parquet(f"{path}/data")
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    model = RandomForestRegressionModel.load(path)
    delete_path(spark, path)
    return model


class HistogramForest(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """``fit_forest`` as a Spark ML estimator."""

    @keyword_only
    def __init__(self, *, settings: ForestSettings = ForestSettings()) -> None:
        super().__init__()
        self.settings = settings

    def setFeaturesCol(self, value: str) -> HistogramForest:
        return self._set(featuresCol=value)

    def setLabelCol(self, value: str) -> HistogramForest:
        return self._set(labelCol=value)

    def setPredictionCol(self, value: str) -> HistogramForest:
        return self._set(predictionCol=value)

    def getMaxMemoryInMB(self) -> int:
        return self.settings.memory_mb

    def _fit(self, dataset: DataFrame) -> RandomForestRegressionModel:
        parts = vector_to_array(F.col(self.getFeaturesCol()))
        first = dataset.select(F.size(parts).alias("n")).first()
        if first is None:
            raise ValueError("no rows to fit trees on")
        columns = [f"_x{i}" for i in range(first["n"])]
        table = dataset.select(F.col(self.getLabelCol()).alias(TARGET), *[parts[i].alias(c) for i, c in enumerate(columns)])
        forest = fit_forest(table, columns, TARGET, self.settings)
        names = {"featuresCol": self.getFeaturesCol(), "labelCol": self.getLabelCol(), "predictionCol": self.getPredictionCol()}
        return to_forest_model(dataset.sparkSession, forest, self.settings, len(columns), names)
