import hashlib

import pytest
from fareweave.llm import sharding as S


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16)


def turns(names, size):
    """The table as shards fill it that really take turns."""
    names = sorted(names)
    walks = [(number("offset:" + n) % size, number("skip:" + n) % (size - 1) + 1) for n in names]
    at, owner, left = [0] * len(names), {}, size
    while left:
        for i, (offset, skip) in enumerate(walks):
            while (offset + at[i] * skip) % size in owner:
                at[i] += 1
            owner[(offset + at[i] * skip) % size] = names[i]
            left -= 1
            if not left:
                break
    return owner


@pytest.mark.parametrize("shards, size", [(1, 7), (3, 31), (7, 101), (20, 251)])
def test_table_is_that_of_turns(spark, shards, size):
    names = S.shard_names(spark, shards)
    got = {r.slot: r.shard for r in S.lookup_table(names, size).collect()}
    assert got == turns([r.shard for r in names.collect()], size)


def test_shares_differ_by_one(spark):
    counts = [r["count"] for r in S.lookup_table(S.shard_names(spark, 6), 101).groupBy("shard").count().collect()]
    assert sorted(counts) == [16, 17, 17, 17, 17, 17]


def test_few_rows_move_when_a_shard_goes(spark):
    names = S.shard_names(spark, 8)
    a = {r.slot: r.shard for r in S.lookup_table(names, 251).collect()}
    b = {r.slot: r.shard for r in S.lookup_table(names.where("shard <> 'shard-00003'"), 251).collect()}
    moved = [s for s in a if a[s] != b[s] and a[s] != "shard-00003"]
    assert "shard-00003" not in b.values() and len(moved) < 251 // 4


def test_edges(spark):
    rows = [(1, "x", 5), (None, "y", 6), (1, "z", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, shard string, slot int")
    got = S.shard_documents(docs, number=3, table_size=31).collect()
    assert len(got) == 3 and got[0].__fields__ == ["doc_id", "slot", "shard"]
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.slot, r.shard))
    assert all(len(v) == 1 for v in by.values()) and by[None] == {(number("key:") % 31, next(iter(by[None]))[1])}
    assert S.shard_documents(docs.limit(0), number=3, table_size=31).count() == 0
    empty = S.lookup_table(S.shard_names(spark, 0), 31)
    assert empty.count() == 0
    assert {r.shard for r in S.place(docs, empty, "doc_id", 31).collect()} == {None}
    for shards, size in ((3, 32), (40, 31), (2, 2_000_003)):
        with pytest.raises(ValueError):
            S.lookup_table(S.shard_names(spark, shards), size)
