"""Placement of rows on shards through a permutation-filled lookup table.

Each shard walks the slots of a prime-sized table in an order of its own (an offset and
a step, from its name). Shards take turns; at its turn a shard claims the first slot of
its order that nobody has claimed. A row's key is hashed to a slot, and the slot's owner
is its shard. All shards own the same number of slots, give or take one, and when a
shard comes or goes few slots change hands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_TABLE_SIZE = 4093  # a prime, 128 slots for each of 32 shards
MAX_TABLE_SIZE = 65_537  # what is broadcast has at most so many rows: a number and a name


def digest_number(value: Column, salt: str) -> Column:
    """52 bits of the MD5 of the salt and a text, as a long. Equal on every engine."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), value)), 1, 13), 16, 10).cast("long")


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: DataFrame, table_size: int = DEFAULT_TABLE_SIZE) -> DataFrame:
    """(slot, shard) for each slot of the table.

    The turns are one fold over a single row: its state holds the owner of each slot, the
    slot each shard looks at next and whose turn it is. A step looks at one slot: if it is
    open, the shard claims it and the turn passes on; if not, the shard goes on to its
    next slot. No shard looks at a slot twice, so shards x slots steps always suffice;
    those after the last claim do nothing. The work depends on the table's size alone.

    Shards take turns in the order of their names; repeated and null names are left out.
    No shards give an empty table. A table size that is not prime, above MAX_TABLE_SIZE
    or below the number of shards is an error.
    """
    if not _is_prime(table_size) or table_size > MAX_TABLE_SIZE:
        raise ValueError(f"the table size must be a prime of at most {MAX_TABLE_SIZE}: {table_size}")
    named = shards.select("shard").where("shard IS NOT NULL").distinct()
    number = named.count()
    if number > table_size:
        raise ValueError(f"{number} shards do not fit a table of {table_size} slots")
    walk = F.struct(
        "shard",
        (digest_number(F.col("shard"), "offset:") % table_size).cast("int").alias("offset"),
        (digest_number(F.col("shard"), "skip:") % (table_size - 1) + 1).cast("int").alias("skip"),
    )
    walks = named.agg(F.array_sort(F.collect_list(walk)).alias("walks")).where(F.size("walks") > 0)
    start = F.struct(
        F.array_repeat(F.lit(-1), table_size).alias("owner"),
        F.col("walks.offset").alias("next"),
        F.lit(0).alias("turn"),
        F.lit(table_size).alias("open"),
    )

    def put(array: Column, at: Column, value: Column, size: int) -> Column:
        """The array with one element, counted from 0, replaced."""
        return F.concat(F.slice(array, F.lit(1), at), F.array(value), F.slice(array, at + 2, F.lit(size)))

    def look(state: Column, _: Column) -> Column:
        turn, owner, following = state["turn"], state["owner"], state["next"]
        slot = F.get(following, turn)
        free = F.get(owner, slot) < 0
        after = (slot + F.get(F.col("walks.skip"), turn)) % table_size
        return F.when(state["open"] == 0, state).otherwise(
            F.struct(
                F.when(free, put(owner, slot, turn, table_size)).otherwise(owner).alias("owner"),
                put(following, turn, after, max(number, 1)).alias("next"),
                F.when(free, (turn + 1) % max(number, 1)).otherwise(turn).alias("turn"),
                (state["open"] - free.cast("int")).alias("open"),
            )
        )

    steps = F.sequence(F.lit(1), F.lit(max(1, number * table_size)))
    filled = walks.select("walks", F.aggregate(steps, start, look)["owner"].alias("owner"))
    return filled.select("walks", F.posexplode("owner").alias("slot", "number")).select(
        F.col("slot").cast("long").alias("slot"), F.get(F.col("walks.shard"), F.col("number")).alias("shard")
    )


def slot_of(key: Column, table_size: int) -> Column:
    """The slot of a key; a null key is placed like an empty text."""
    return digest_number(F.coalesce(key.cast("string"), F.lit("")), "key:") % table_size


def place(docs: DataFrame, table: DataFrame, key: str | Column, table_size: int = DEFAULT_TABLE_SIZE) -> DataFrame:
    """``docs`` with ``slot`` and ``shard``; columns of these names are replaced.

    Rows stay where they are: the table, of at most MAX_TABLE_SIZE rows, goes to them.
    Equal keys meet on one shard. Null and empty keys share the slot of the empty text;
    an empty table gives no rows; without any shard, ``shard`` is null.
    """
    key = F.col(key) if isinstance(key, str) else key
    slotted = docs.drop("shard").withColumn("slot", slot_of(key, table_size))
    return slotted.join(F.broadcast(table.select("slot", "shard")), "slot", "left").select(
        *[c for c in docs.columns if c not in ("slot", "shard")], "slot", "shard"
    )


def shard_names(spark: SparkSession, number: int) -> DataFrame:
    return spark.range(number).select(F.format_string("shard-%05d", "id").alias("shard"))


def shard_documents(
    docs: DataFrame, key: str = "doc_id", number: int = 32, table_size: int = DEFAULT_TABLE_SIZE
) -> DataFrame:
    """``docs`` placed on ``number`` shards named shard-00000, shard-00001, ... by ``key``."""
    return place(docs, lookup_table(shard_names(docs.sparkSession, number), table_size), key, table_size)
