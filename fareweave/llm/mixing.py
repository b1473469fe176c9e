"""Mixing sources to target weights by Pareto order sampling.

A source whose target is e times its size takes floor(e) whole copies of each of its
documents for certain. What is left of the target is a sample of fixed size, counted in
words, in which each document has the inclusion probability p = e - floor(e). Every
document draws a uniform number u and is ranked by its odds u / (1 - u) divided by the
inclusion odds p / (1 - p); the sample is the head of that order.

The head is found without sorting a source: words are added up by the leading bits of
the rank, then by the next bits inside the range where the target is reached, and only
the few documents that share all those bits are put in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fareweave.llm.sharding import digest_number
from fareweave.storage import materialize

WORD = r"[^\x20\x09-\x0D]+"
DIGIT = 12  # bits of the rank that one round looks at
ROUNDS = 2
RANK_BITS = DIGIT * (ROUNDS + 1)


def word_count(text: Column) -> Column:
    """Runs of other characters than space and 09 to 0D; 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _key(source: Column) -> Column:
    """A source as a text that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def cycled_weights(docs: DataFrame, source_col: str = "source", cycle: Sequence[float] = (3, 1, 2)) -> DataFrame:
    """(source, weight): the weights of ``cycle``, in turn, for the sources by code point, null last.

    Sources, not documents, are numbered in one task.
    """
    sources = docs.select(F.col(source_col).alias("source")).distinct()
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    return sources.select("source", F.get(weights, number % len(cycle)).alias("weight"))


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``sizes`` (source, weight, source_size) with ``target``.

    ``share`` times all sizes are dealt out by weight; no source gets more than ``most``
    times its size, and what is above is dealt out again to the others by weight until
    none is above. A null or negative weight counts as 0. If all sources are at their
    limit, the rest is not dealt out. The driver sees a few sums for each round.
    """
    weight = F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0))
    limits = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(most)))

    def sums(per_weight: float):
        above = F.col("limit") <= F.col("weight") * F.lit(per_weight)
        return limits.agg(
            F.coalesce(F.sum(F.when(above, F.col("limit"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)),
            F.coalesce(F.sum("source_size"), F.lit(0)),
        ).first()

    full, open_weight, total = sums(-1.0)
    whole, per_weight = total * float(share), 0.0
    while open_weight > 0:
        latest = (whole - full) / open_weight
        if latest == per_weight:
            break
        per_weight = latest
        full, open_weight, _ = sums(per_weight)
    return limits.withColumn("target", F.least(F.col("limit"), F.col("weight") * F.lit(per_weight))).drop("limit")


def _rank(seed: str) -> Column:
    """Where a document stands in its source's order, from 0 to 1: q / (1 + q) for the odds ratio q."""
    u = digest_number(F.coalesce(F.col("id").cast("string"), F.lit("")), seed) / F.lit(float(2**52))
    p = F.col("chance")
    return u * (1 - p) / (u * (1 - p) + (1 - u) * p)


def _cuts(sampled: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, cut, gap): the last document of each source's sample, and the words still missing after it.

    ``sampled``: key, place (rank, id, row), size. ``wanted``: key, rest (words to take).
    Sources that take all have no row.
    """
    bits = F.floor(F.col("place.rank") * float(2**RANK_BITS)).cast("long")
    sampled = sampled.withColumn("bits", F.least(bits, F.lit(2**RANK_BITS - 1).cast("long")))
    reached = wanted.withColumn("head", F.lit(0).cast("long"))
    for level in range(1, ROUNDS + 1):
        low = RANK_BITS - DIGIT * level
        inside = sampled.join(reached, "key").where(F.shiftright("bits", low + DIGIT) == F.col("head"))
        words = inside.groupBy("key", "rest", F.shiftright("bits", low).alias("next")).agg(F.sum("size").alias("words"))
        before = F.coalesce(
            F.sum("words").over(Window.partitionBy("key").orderBy("next").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        )
        crossing = words.withColumn("before", before).where(
            (F.col("before") <= F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest"))
        )
        reached = materialize(
            crossing.select("key", (F.col("rest") - F.col("before")).alias("rest"), F.col("next").alias("head")),
            "reached",
        )
    inside = sampled.join(reached, "key").where(F.shiftright("bits", DIGIT) == F.col("head"))
    total = F.sum("size").over(
        Window.partitionBy("key").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    id_type = sampled.schema["place"].dataType["id"].dataType
    start = F.struct(
        (F.col("head") / F.lit(float(2 ** (DIGIT * ROUNDS)))).alias("rank"),
        F.lit(None).cast(id_type).alias("id"),
        F.lit(-1).cast("long").alias("row"),
    )
    fits = F.col("total") <= F.col("rest")
    last = (
        inside.withColumn("total", total)
        .groupBy("key", "rest", "head")
        .agg(F.max(F.when(fits, F.col("place"))).alias("last"), F.max(F.when(fits, F.col("total"))).alias("used"))
    )
    return last.select(
        "key", F.coalesce("last", start).alias("cut"), (F.col("rest") - F.coalesce("used", F.lit(0))).alias("gap")
    )


def plan_mix(
    docs: DataFrame,
    weights: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    size: Column | None = None,
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix:",
) -> tuple[DataFrame, DataFrame]:
    """The documents of a mix, and the decisions by source.

    The first table has one row per row of ``docs``: id, key (of the source), row, size.
    The second has one row per source: key, source, source_size, target, whole (certain
    copies), chance, cut and extra. ``copies`` turns both into a number of copies.

    Each sample ends with the last document that still fits the target; one more document
    of the source, the one whose size comes closest to the words still missing, joins if
    that brings the total closer. So a source misses its target by less than the size of
    one document, and by little where it has many.

    ``size`` defaults to the words of ``text``; null sizes count as 0. ``weights`` holds
    (source, weight), one row per source; a source without a row weighs 0. A null source
    is a source. Documents with equal ids draw the same number; ties are put in order by
    id and by the position in which the row is read. An empty table gives empty tables.
    A source of size 0 takes nothing.
    """
    size = word_count(F.col("text")) if size is None else size
    rows = materialize(
        docs.select(
            F.col(id_col).alias("id"),
            _key(F.col(source_col)).alias("key"),
            F.monotonically_increasing_id().alias("row"),
            F.coalesce(size.cast("long"), F.lit(0).cast("long")).alias("size"),
        ),
        "sizes",
    )
    sizes = rows.groupBy("key").agg(F.sum("size").alias("source_size"))
    weighed = weights.select(_key(F.col("source")).alias("key"), "source", "weight")
    shares = targets(materialize(sizes.join(weighed, "key", "left"), "source-sizes"), share, most)
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(expected)
    shares = materialize(
        shares.withColumn("whole", whole.cast("long"))
        .withColumn("chance", expected - whole)
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")),
        "shares",
    )
    open_shares = shares.where("chance > 0")
    sampled = rows.join(open_shares.select("key", "chance"), "key").select(
        "key", F.struct(_rank(seed).alias("rank"), "id", "row").alias("place"), "size"
    )
    cuts = materialize(_cuts(sampled, open_shares.select("key", "rest")), "cuts")
    off = F.abs(F.col("size") - F.col("gap"))
    extra = (
        sampled.join(cuts, "key")
        .where((F.col("place") > F.col("cut")) & (off < F.col("gap")))
        .groupBy("key")
        .agg(F.min(F.struct(off.alias("off"), "place")).alias("extra"))
        .select("key", F.col("extra.place").alias("extra"))
    )
    decisions = shares.join(cuts.select("key", "cut"), "key", "left").join(extra, "key", "left")
    return rows, materialize(decisions.drop("weight", "rest"), "decisions")


def copies(seed: str = "mix:") -> Column:
    """The number of copies of a row with id, row, and the columns of its source's decisions."""
    place = F.struct(_rank(seed).alias("rank"), "id", "row")
    # A sample without a cut takes all.
    chosen = F.col("cut").isNull() | (place <= F.col("cut")) | F.coalesce(place == F.col("extra"), F.lit(False))
    return F.col("whole") + F.when((F.col("chance") > 0) & chosen, 1).otherwise(0)


def mix_sizes(docs: DataFrame, weights: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, copies and taken (words); see ``plan_mix``."""
    rows, decisions = plan_mix(docs, weights, id_col, **options)
    joined = rows.join(decisions, "key").withColumn("copies", copies())
    return joined.select(
        F.col("id").alias(id_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix_documents(
    docs: DataFrame, weights: DataFrame, id_col: str = "doc_id", source_col: str = "source", **options
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with its columns; see ``plan_mix``.

    ``docs`` should be a stored table, read twice; rows that share an id are told apart by
    their position in it. The decisions, one row per source, come to the documents.
    """
    rows, decisions = plan_mix(docs, weights, id_col, source_col, **options)
    columns = [F.col(c).alias(f"_doc_{c}") for c in docs.columns]
    own = docs.select(
        *columns,
        F.col(id_col).alias("id"),
        _key(F.col(source_col)).alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )
    chosen = own.join(decisions, "key").withColumn("_copies", copies()).where("_copies > 0")
    repeated = chosen.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return repeated.select(*[F.col(f"_doc_{c}").alias(c) for c in docs.columns])
