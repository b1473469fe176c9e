import random

import numpy as np
import pytest
import xxhash
from fareweave.llm import simhash as S
from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 4), st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4))
def test_every_pair_within_the_radius_meets(radius, number, flips):
    other = number
    for f in list(flips)[:radius]:
        other ^= 1 << f
    masks = S.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    assert any(number & m == other & m for m in masks)


def plain(text, length=4):
    words = bytes(text or "", "utf-8").lower().split()
    if not words:
        return 0
    runs = [words] if len(words) < length else [words[i : i + length] for i in range(len(words) - length + 1)]
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["É", "é", "ß x", "日本"]
    out = [None, "", " \t\n", "one", "One", "a b c", "a b c d", "A B C\x0bD", "x " * 70_000, " "]
    for _ in range(60):
        base = rng.choices(words, k=rng.randint(1, 200))
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append("  ".join(copy))
    return out + out[:20]


def brute(ids, prints, radius):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, doc_id in enumerate(ids):
        root = find(i)
        if doc_id is not None:
            least[root] = min(least.get(root, doc_id), doc_id)
    return [least.get(find(i)) for i in range(len(ids))]


@pytest.mark.parametrize("block", [4096, 3])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK", block)
    rows = [(i if i % 17 else None, t) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 as id", "'p' as print", "1 as fingerprint")
    got = S.near_duplicates(docs.repartition(5)).collect()
    prints = [plain(t) for _, t in rows]
    expected = brute([i for i, _ in rows], prints, 4)
    want = sorted(((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, expected, strict=True)), key=str)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == want


def test_a_chain_is_one_component(spark):
    chain = [sum(1 << b for b in range(3 * i)) for i in range(20)]
    prints = spark.createDataFrame([(p,) for p in chain], "fingerprint long")
    links = S.fingerprint_links(prints)
    from fareweave.llm.components import connected_components

    found = connected_components(links).collect()
    assert {r.node for r in found} == set(chain) and len({r.component for r in found}) == 1


def test_the_bits_of_a_long_text_are_counted_in_parts(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(3000)).encode()
    whole = S._fingerprints([text, None, text], 4, 42)
    monkeypatch.setattr(S, "PENDING", 100)
    assert (S._fingerprints([text, None, text], 4, 42) == whole).all() and whole[0] == plain(text.decode()) and whole[1] == 0


def test_one_of_each_stays(spark):
    rows = [(5, "a b c d e"), (3, "A b c d e"), (9, None), (8, ""), (7, "other words stand here now"), (None, "a b c d e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as _id", "2 as component_id")
    kept = S.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 7, 8]
    assert S.keep_one_of_each(docs.limit(0)).count() == 0


def test_empty_table(spark):
    assert S.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert (np.array(S.covering_masks(1)) > 0).all()
