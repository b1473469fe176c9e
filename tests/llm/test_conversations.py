import hashlib
import itertools
import re

import duckdb
import pyarrow as pa
import pytest
from checker import compare
from fareweave.llm import conversations as C
from fareweave.llm.oracle import ORACLES
from hypothesis import given, settings
from hypothesis import strategies as st


def brute(rows):
    """All edits of a few rows (letter, truncated, must go) with up to two inserts at each place; the cheapest, least audit."""
    best = None
    inserts = ["", "u", "a", "ua", "au"]
    choices = [
        [("D", "", 4)] + ([] if must else [("K", letter, 3 * cut), ("R", "u", 3 + 3 * cut), ("R", "a", 3 + 3 * cut)])
        for letter, cut, must in rows
    ]
    for edits in itertools.product(*choices):
        for gaps in itertools.product(inserts, repeat=len(rows) + 1):
            given_roles = "".join(g + e[1] for g, e in zip(gaps, edits)) + gaps[-1]
            if re.fullmatch("(s?(ua)+)?", given_roles):
                audit = "".join("I" * len(g) + e[0] for g, e in zip(gaps, edits)) + "I" * len(gaps[-1])
                key = (sum(e[2] for e in edits) + 3 * sum(map(len, gaps)), audit)
                best = key if best is None or key < best else best
    return best


def parsed(rows):
    repair = C.Repair()
    for letter, cut, must in rows:
        repair.row(letter, bool(cut), must, b"r", b"t")
    return repair.result()[:2]


def test_all_short_conversations_against_every_edit():
    kinds = [("u", 0, False), ("a", 0, False), ("s", 0, False), ("x", 0, False), ("u", 1, False), ("a", 0, True)]
    for n in range(4):
        for rows in itertools.product(kinds if n < 3 else kinds[1:5:2], repeat=n):
            assert parsed(rows) == brute(rows), rows


def walk(rows):
    """The same by a finite automaton that keeps whole audits and drops no state."""
    after = {"n": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "e"}, "e": {"u": "u"}}

    def inserted(states):
        for _ in range(3):
            for state, (cost, audit) in list(states.items()):
                for symbol in "ua":
                    if symbol in after[state]:
                        new, key = after[state][symbol], (cost + 3, audit + "I")
                        states[new] = min(states.get(new, key), key)
        return states

    states = {"n": (0, "")}
    for letter, cut, must in rows:
        found = {}
        for state, (cost, audit) in inserted(states).items():
            options = [(state, cost + 4, "D")]
            if not must:
                options += [(after[state].get(letter), cost + 3 * cut, "K")]
                options += [(after[state].get(r), cost + 3 + 3 * cut, "R") for r in "ua"]
            for new, total, edit in options:
                if new:
                    found[new] = min(found.get(new, (total, audit + edit)), (total, audit + edit))
        states = found
    return min(v for k, v in inserted(states).items() if k in "ne")


ROW = st.tuples(st.sampled_from("uuaasx"), st.integers(0, 1), st.sampled_from([False, False, True]))


@settings(max_examples=300, deadline=None)
@given(st.lists(ROW, max_size=40))
def test_longer_conversations(rows):
    assert parsed(rows) == walk(rows)


@pytest.mark.parametrize("letter", ["s", "x", "u", "a"])
def test_long_runs_of_one_role(letter):
    """Stacks that differ for long agree on nothing; their edits stay apart and in order."""
    rows = [(letter, 0, i % 7 == 3) for i in range(300)]
    assert parsed(rows) == walk(rows)


def test_memory_does_not_grow_with_the_rows():
    repair = C.Repair()
    for i in range(20_000):
        repair.row("ua"[i % 2], i % 3 == 0, i % 5 == 0, b"user", b"text")
        depth, path = 0, repair.paths[0]
        while path is not None and depth < 100:
            path, depth = path[0], depth + 1
        assert depth < 50 and len(repair.tops) <= 6


SCHEMA = "conv_id long, turn long, role string, text string"
ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hello there."), (1, 2, "assistant", "Hi."), (1, 5, "user", "And?"),
    (2, 0, "assistant", None), (2, 1, None, "What."), (2, 1, "user", "What."), (2, 1, "user", "What."),
    (3, None, "user", "a."), (3, None, "assistant", "b."), (3, 0, "user", "a."), (3, 7, "tool", "z"),
    (None, None, None, None), (None, 3, "user", "x"), (None, 3, "user", "x"), (None, 9, "", "y."),
    (4, 1, "user", "w" * 300_000), (4, 2, "assistant", " \t\n\x0b\f\r"), (4, 3, "assistant", "é漢!  "), (5, 0, "user", ""),
]


def messy(conversations=40):
    rows = list(ROWS)
    texts = ["One.", "Two", "", " ", "Three!", None, "A.b.c", " ."]
    roles = ["user", "assistant", "system", "tool", None, "user", "assistant"]
    for i in range(conversations):
        for j in range(i % 13):
            k = i * 31 + j * 7
            rows.append((100 + i, None if k % 11 == 0 else j - (k % 5 == 0), roles[(k * k + j) % 7], texts[(k // 3 + j * j) % 8]))
    return rows


def test_against_sql_on_messy_rows(spark):
    rows = messy()
    con = duckdb.connect()
    table = pa.table({n: [r[i] for r in rows] for i, n in enumerate(["conv_id", "turn", "role", "text"])})
    con.register("given", table)
    con.execute("CREATE TABLE conversations AS SELECT * FROM given")
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    docs = docs.selectExpr("*", "1 as kind", "'x' as symbol", "2 as digest", "true as blank", "0 as cut")
    assert compare(con, ORACLES["op13_conversations"], C.damage_and_repair(docs)) == []


def test_rows_after_the_repair(spark):
    rows = [
        ("x", 0, "user", "Hi."), ("x", 1, "user", "Hi."), ("x", 2, "user", "No end"), ("x", 4, "assistant", "End."),
        ("y", 0, None, None), ("z", 1, "assistant", "A."),
    ]
    got = {r.conv_id: r for r in C.repair(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")).collect()}
    x, y, z = got["x"], got["y"], got["z"]
    assert (x.gaps, x.blank, x.duplicate, x.truncated, x.illegal) == (1, 0, 1, 1, 2)
    # Keep, delete the copy, and the truncated row: deleting it costs 4, keeping it 3 and an inserted answer 3.
    assert (x.cost, x.audit) == (8, "KDDK")
    assert x.repaired_sha256 == hashlib.sha256(b"user:Hi.\nassistant:End.").hexdigest()
    assert (y.cost, y.audit, y.gaps, y.repaired_sha256) == (0, "", 0, hashlib.sha256(b"").hexdigest())
    assert (z.cost, z.audit) == (3, "IK") and z.repaired_sha256 == hashlib.sha256(b"user:\nassistant:A.").hexdigest()


def test_empty_table(spark):
    got = C.damage_and_repair(spark.createDataFrame([], SCHEMA))
    assert got.collect() == [] and got.columns == ["conv_id", *C.COUNTS, "audit", "repaired_sha256"]


def test_order_of_the_input_does_not_matter(spark):
    rows = messy(20)
    a = C.damage_and_repair(spark.createDataFrame(rows, SCHEMA).repartition(1)).collect()
    b = C.damage_and_repair(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7)).collect()
    assert sorted(a, key=str) == sorted(b, key=str)
