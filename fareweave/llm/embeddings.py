"""Near-duplicate vectors by small-world graphs, one per shard.

Equal vectors are counted as one. The distinct ones are dealt to shards; each shard
builds a graph of its vectors, and the vectors of every shard query every shard's graph.
A pair counts if the search for either of its vectors finds it. In each such task queries are
compared with all vectors of the graph until enough of them have links to other vectors:
beams are doubled until that finds the wanted share of the links of a query, on
average over the queries of small groups and over those of large ones. Each link is verified by its cosine in double
precision; components are the union of all links.
"""

from __future__ import annotations

import logging
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareweave.llm.components import connected_components
from fareweave.llm.hnsw import Graph
from fareweave.storage import materialize

SHARD_ROWS = 50_000  # vectors of a graph, at most about
LEAST_SHARDS = 6  # a small table still keeps several tasks busy
FIRST_BEAM = 48
AUDITED = 64  # queries with links that a task compares with all vectors, of each side and kind of group
SMALL_GROUP = 16  # links of a query that counts as one of a small group, at most
BLOCK = 1024  # queries whose links are held at once
WANTED_RECALL = 0.99
SLACK = 1e-5  # what single precision may hide of a cosine

LOG = logging.getLogger(__name__)


def usable(vector: Column) -> Column:
    """Whether a vector can be compared: not null, without null or non-finite components, and not zero."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & whole & F.exists(vector, lambda x: x != 0.0), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _unit(vectors: np.ndarray) -> np.ndarray:
    # The largest component first, so that squares of tiny or huge ones stay finite.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _build(table: pa.Table) -> pa.Table:
    """The graph of one shard, as bytes."""
    width, shard = table.column("width")[0].as_py(), table.column("shard")[0].as_py()
    nodes = table.column("node").to_numpy()
    order = np.argsort(nodes)
    unit = _unit(_matrix(table.column("vector"), width))[order]
    graph = Graph.build(unit.astype(np.float32), seed=shard)
    blobs = [
        nodes[order].astype(np.int64),
        table.column("copies").to_numpy()[order].astype(np.int64),
        unit,
        graph.levels,
        np.concatenate([x.ravel() for x in graph.links]),
        np.array([x.shape[1] for x in graph.links], dtype=np.int64),
    ]
    names = ["nodes", "copies", "unit", "levels", "links", "widths"]
    out = {"width": [width], "shard": [shard], "entry": [graph.entry]} | {
        n: pa.array([b.tobytes()], pa.binary()) for n, b in zip(names, blobs, strict=True)
    }
    return pa.table(out).cast(
        pa.schema(
            [("width", pa.int32()), ("shard", pa.int32()), ("entry", pa.int32()), *((n, pa.binary()) for n in names)]
        )
    )


BUILT = "width int, shard int, entry int, nodes binary, copies binary, unit binary, levels binary, links binary, widths binary"


FOUND = {"a": pa.int64(), "b": pa.int64(), "n": pa.int64(), "small": pa.bool_(), "recall": pa.float64()}


class Shard(NamedTuple):
    nodes: np.ndarray
    copies: np.ndarray
    unit: np.ndarray
    graph: Graph


def _load(row: dict) -> Shard:
    nodes = np.frombuffer(row["nodes"], np.int64)
    unit = np.frombuffer(row["unit"], np.float64).reshape(len(nodes), -1)
    flat, links, at = np.frombuffer(row["links"], np.int32), [], 0
    for width in np.frombuffer(row["widths"], np.int64).tolist():
        links.append(flat[at : at + len(nodes) * width].reshape(len(nodes), width))
        at += len(nodes) * width
    levels = np.frombuffer(row["levels"], np.int64)
    graph = Graph(unit.astype(np.float32), levels, links, row["entry"])
    return Shard(nodes, np.frombuffer(row["copies"], np.int64), unit, graph)


def _forest(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """The least number that each of ``size`` numbers is linked with, by steps."""
    least = np.arange(size)
    while True:
        old = least.copy()
        low = np.minimum(least[a], least[b])
        np.minimum.at(least, a, low)
        np.minimum.at(least, b, low)
        np.minimum.at(least, old, least)
        least = least[least]
        if (least == old).all():
            return least


def _pack(keys: np.ndarray) -> np.ndarray:
    """Places in a square of BLOCK by BLOCK, as numbers or, if that takes less, as bits."""
    if 32 * len(keys) <= BLOCK * BLOCK:
        return keys.astype(np.uint32)
    tile = np.zeros(BLOCK * BLOCK, dtype=bool)
    tile[keys] = True
    return np.packbits(tile)


def _unpack(kept: np.ndarray) -> np.ndarray:
    if kept.dtype == np.uint8:
        return np.unpackbits(kept).view(bool).reshape(BLOCK, BLOCK)
    tile = np.zeros(BLOCK * BLOCK, dtype=bool)
    tile[kept] = True
    return tile.reshape(BLOCK, BLOCK)


def _pairs(low: Shard, high: Shard, one: bool, least: float, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(vectors of high, vectors of low) by blocks of high: each pair that the search for either one finds, once.

    Within a shard the later vector stands first. What the search for a vector of low finds
    waits, as squares of bits at most, until the block of the other vector is searched.
    """
    waiting: dict[int, list[tuple[int, np.ndarray]]] = defaultdict(list)

    def wait(first: int, v: np.ndarray, q: np.ndarray) -> None:
        """``v``: places in the block of low from ``first`` on; ``q``: vectors of high."""
        order = np.argsort(q // BLOCK, kind="stable")
        v, q = v[order], q[order]
        blocks, starts = np.unique(q // BLOCK, return_index=True)
        ends = np.append(starts, len(q))[1:]
        for block, a, b in zip(blocks.tolist(), starts.tolist(), ends.tolist(), strict=True):
            waiting[block].append((first, _pack((q[a:b] - block * BLOCK) * BLOCK + v[a:b])))

    if not one:
        for first in range(0, len(low.nodes), BLOCK):
            wait(first, *high.graph.search_above(low.graph.vectors[first : first + BLOCK], least, beam))
    for first in range(0, len(high.nodes), BLOCK):
        q, v = low.graph.search_above(high.graph.vectors[first : first + BLOCK], least, beam)
        rows = min(BLOCK, len(high.nodes) - first)
        if one:
            later = v >= first + rows
            wait(first, q[later], v[later])
            q, v = q[~later], v[~later]
        table = np.zeros((rows, len(low.nodes)), dtype=bool)
        table[q, v] = True
        for at, kept in waiting.pop(first // BLOCK, []):
            part = table[:, at : at + BLOCK]
            part |= _unpack(kept)[:rows, : part.shape[1]]
        if one:
            square = table[:, first : first + rows]
            square[:] = np.tril(square | square.T, -1)
        q, v = np.nonzero(table)
        yield q + first, v


def _audited(asking: Shard, asked: Shard, threshold: float, seed: int) -> tuple[list, list]:
    """(query, its true links) of queries that have links to other vectors: of small groups, and of large ones.

    Queries are drawn until AUDITED of small groups are found; all are compared if there are fewer.
    """
    small, large = [], []
    queries, vectors = asking.graph.vectors, asked.graph.vectors
    order = np.random.default_rng(seed).permutation(len(queries))
    for first in range(0, len(order), 256):
        at = order[first : first + 256]
        near = queries[at] @ vectors.T >= np.float32(threshold - SLACK)
        if asking is asked:
            near[np.arange(len(at)), at] = False
        for row in np.flatnonzero(near.any(axis=1)):
            links = np.flatnonzero(near[row])
            kind = small if len(links) <= SMALL_GROUP else large
            if len(kind) < AUDITED:
                links = links[asked.unit[links] @ asking.unit[at[row]] >= threshold]
                kind += [(int(at[row]), links)] if len(links) else []
        if len(small) >= AUDITED:
            break
    return small, large


def _recalls(audited: list, asking: Shard, asked: Shard, least: float, beam: int) -> np.ndarray:
    """For each audited query, the share of its true links that its own search or the other vector's finds."""
    at = np.array([q for q, _ in audited], dtype=np.int64)
    sizes = np.array([len(links) for _, links in audited], dtype=np.int64)
    row, true = np.repeat(np.arange(len(at)), sizes), np.concatenate([np.zeros(0, np.int64), *[x for _, x in audited]])
    n, m = len(asked.nodes), len(asking.nodes)
    hit = np.zeros(len(row), dtype=bool)
    for first in range(0, len(at), 64):
        q, v = asked.graph.search_above(asking.graph.vectors[at[first : first + 64]], least, beam)
        hit |= np.isin(row * n + true, (q + first) * n + v)
    others = np.unique(true[~hit])
    for first in range(0, len(others), 64):
        some = others[first : first + 64]
        v, q = asking.graph.search_above(asked.graph.vectors[some], least, beam)
        hit |= np.isin(true * m + at[row], some[v] * m + q)
    return np.bincount(row, hit, minlength=len(at)) / np.maximum(sizes, 1)


def _search(threshold: float, wanted: float):
    def search(key: tuple, table: pa.Table) -> pa.Table:
        """The links between two shards, or within one: counts by node, and a forest that connects what the links connect.

        A row with ``recall`` is what the audit found of one kind of group: ``small`` or not, audited queries in ``n``.
        """
        rows = sorted(table.to_pylist(), key=lambda r: r["shard"])
        one = key[1].as_py() == key[2].as_py()
        if len(rows) < 2 and not one:
            return pa.table({n: pa.array([], t) for n, t in FOUND.items()})
        low = _load(rows[0])
        high = low if one else _load(rows[1])
        least = np.float32(threshold - SLACK)
        sides = [(high, low)] if one else [(high, low), (low, high)]
        audits = [_audited(asking, asked, threshold, len(asking.nodes)) for asking, asked in sides]
        beam = FIRST_BEAM
        while True:
            recalls = [
                np.concatenate([_recalls(a[kind], *side, least, beam) for a, side in zip(audits, sides, strict=True)])
                for kind in (0, 1)
            ]
            if beam >= max(len(low.nodes), len(high.nodes)) or all(not len(r) or r.mean() >= wanted for r in recalls):
                break
            beam *= 2
        own, other = np.zeros(len(high.nodes), np.int64), np.zeros(len(low.nodes), np.int64)
        total = len(low.nodes) + (0 if one else len(high.nodes))
        shift = 0 if one else len(low.nodes)
        root = np.arange(total)
        # Without an audited query, all were compared with all, and none has a link.
        for q, v in _pairs(low, high, one, least, beam) if any(map(len, recalls)) else ():
            for at in range(0, len(q), 1_000_000):
                a, b = q[at : at + 1_000_000], v[at : at + 1_000_000]
                close = np.einsum("ij,ij->i", high.unit[a], low.unit[b]) >= threshold
                a, b = a[close], b[close]
                np.add.at(own, a, low.copies[b])
                np.add.at(other, b, high.copies[a])
                root = _forest(np.concatenate([a + shift, np.arange(total)]), np.concatenate([b, root]), total)
        names = low.nodes if one else np.concatenate([low.nodes, high.nodes])
        counts = own + other if one else np.concatenate([other, own])
        linked, moved = np.flatnonzero(counts), np.flatnonzero(root != np.arange(total))
        told = [(kind == 0, r) for kind, r in enumerate(recalls) if len(r)]
        plain = len(linked) + len(moved)
        columns = {
            "a": [*names[linked].tolist(), *names[moved].tolist(), *[None] * len(told)],
            "b": [*[None] * len(linked), *names[root[moved]].tolist(), *[None] * len(told)],
            "n": [*counts[linked].tolist(), *[0] * len(moved), *[len(r) for _, r in told]],
            "small": [*[None] * plain, *[small for small, _ in told]],
            "recall": [*[None] * plain, *[float(r.mean()) for _, r in told]],
        }
        return pa.table({n: pa.array(columns[n], t) for n, t in FOUND.items()})

    return search


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.95,
    shard_rows: int = SHARD_ROWS,
    wanted_recall: float = WANTED_RECALL,
) -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id, kept.

    Vectors of one length are linked if their cosine is at least ``threshold``; rows with
    equal vectors are links of each other. ``n_links`` counts the other rows linked,
    ``component_id`` is the least id that links reach, and ``kept`` holds if it is the
    row's own. Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing, nor do rows of other lengths. A row whose component has no id but
    null has a null component_id and is not kept; rows that share an id are told apart.
    Other columns are not looked at. An empty table gives an empty table.

    The number of shards follows the number of distinct vectors, ``shard_rows`` to a shard.
    The recall that the audits found is logged, that of small groups apart.
    """
    rows = materialize(
        vectors.select(
            F.col(id_col).alias("id"),
            F.when(usable(F.col(vector_col)), F.col(vector_col).cast("array<double>")).alias("vector"),
        ),
        "vectors",
    )
    distinct = (
        rows.where("vector IS NOT NULL")
        .groupBy("vector")
        .agg(F.min("id").alias("least_id"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = materialize(distinct, "distinct-vectors")
    shards = max(LEAST_SHARDS, -(-nodes.count() // shard_rows))
    dealt = nodes.select(
        "node",
        "copies",
        "vector",
        F.size("vector").alias("width"),
        F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard"),
    )
    graphs = materialize(dealt.groupBy("width", "shard").applyInArrow(_build, BUILT), "graphs")
    other = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("other")
    tasks = graphs.select("*", other).select(
        "*", F.least("shard", "other").alias("low"), F.greatest("shard", "other").alias("high")
    )
    found = materialize(
        tasks.drop("other")
        .groupBy("width", "low", "high")
        .applyInArrow(_search(threshold, wanted_recall), "a long, b long, n long, small boolean, recall double"),
        "vector-links",
    )
    report = found.where("recall IS NOT NULL").groupBy("small")
    for r in report.agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("recall")) / F.sum("n")).alias("mean"), F.min("recall").alias("least")).collect():
        LOG.info(
            "%s groups: %d queries audited, mean recall %.4f, least of a task %.4f",
            "small" if r["small"] else "large", r["n"], r["mean"], r["least"],
        )
    counts = found.where("a IS NOT NULL AND b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    members = connected_components(found.where("b IS NOT NULL"))
    rooted = (
        nodes.join(members, "node", "left")
        .join(counts, "node", "left")
        .select(
            "node",
            "vector",
            "least_id",
            F.coalesce("component", "node").alias("component"),
            (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        )
    )
    ids = rooted.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = materialize(rooted.join(ids, "component").select("vector", "n_links", "component_id"), "named-vectors")
    alone = F.col("vector").isNull()
    component = F.when(alone, F.col("id")).otherwise(F.col("component_id"))
    return rows.join(named, "vector", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
