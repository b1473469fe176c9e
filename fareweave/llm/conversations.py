"""Conversations repaired to the order of roles that training expects, by generalised LR parsing.

The grammar ``(s?(ua)+)?`` over the first letters of roles is turned into LR tables. A parse
keeps a graph-structured stack: all stacks that some choice of edits leads to, of which those
with equal tops merge into the one of least (cost, audit). A row may be kept, reroled or
deleted, and rows may be inserted anywhere; the audit is the list of the edits' letters.

Faults that need one row only, and the first of each set of equal rows, are found in Spark
before rows meet. Rows then go to their conversation's task once, sorted, and the parser
reads them as a stream: it holds the stacks of the last row, not the rows, and each stack
carries a running digest of the text it would give. What all stacks agree on leaves them.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the task: the grammar of role letters, the edits and what they cost.
GRAMMAR = (("S", ""), ("S", "sP"), ("S", "P"), ("P", "Pua"), ("P", "ua"))
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
NAMES = {"u": "user", "a": "assistant"}
SPACE = " \t\n\x0b\f\r"
# Any stack can do what another can for this much more: delete a system row, insert a row.
SLACK = DELETE + INSERT
OUT_ROWS, OUT_BYTES = 2000, 4_000_000  # of a batch of results

Item = tuple[int, int]  # rule, place of the dot
Stack = tuple[int, ...]  # states, the top last


def _closure(items: set[Item]) -> frozenset[Item]:
    found, todo = set(items), list(items)
    while todo:
        rule, dot = todo.pop()
        body = GRAMMAR[rule][1]
        for new, (head, _) in enumerate(GRAMMAR):
            if dot < len(body) and body[dot] == head and (new, 0) not in found:
                found.add((new, 0))
                todo.append((new, 0))
    return frozenset(found)


def lr_tables() -> tuple[list[dict[str, int]], list[list[int]]]:
    """Per state: where each symbol leads, and the rules that are complete there. State 0 begins."""
    states = [_closure({(r, 0) for r, (head, _) in enumerate(GRAMMAR) if head == "S"})]
    moves: list[dict[str, int]] = []
    for state in states:  # grows while it is read
        moved: dict[str, set[Item]] = {}
        for rule, dot in sorted(state):
            body = GRAMMAR[rule][1]
            if dot < len(body):
                moved.setdefault(body[dot], set()).add((rule, dot + 1))
        moves.append({})
        for symbol, items in moved.items():
            target = _closure(items)
            if target not in states:
                states.append(target)
            moves[-1][symbol] = states.index(target)
    done = [[r for r, dot in sorted(s) if dot == len(GRAMMAR[r][1])] for s in states]
    return moves, done


MOVES, DONE = lr_tables()


def shift(stack: Stack, symbol: str) -> Stack | None:
    """The stack after a symbol, reduced by every phrase that it completes; None if the symbol cannot follow."""
    if symbol not in MOVES[stack[-1]]:
        return None
    stack = (*stack, MOVES[stack[-1]][symbol])
    while not MOVES[stack[-1]]:  # nothing can follow inside: the phrase is complete
        head, body = GRAMMAR[DONE[stack[-1]][0]]
        stack = stack[: len(stack) - len(body)]
        stack = (*stack, MOVES[stack[-1]][head])
    return stack


def accepts(stack: Stack) -> bool:
    return any(GRAMMAR[r][0] == "S" for r in DONE[stack[-1]])


# (stack, cost, number of the old stack that it comes from, its edits since: letter and role given)
Edits = tuple[tuple[str, str | None], ...]
Top = tuple[Stack, int, int, Edits]


def _letters(edits: Edits) -> str:
    return "".join(letter for letter, _ in edits)


def _merge(tops: dict[int, Top], top: Top | None) -> bool:
    """Keep the top if it is the first or the least of its state. Old stacks are numbered by the order of their audits."""
    if top is None:
        return False
    state = top[0][-1]
    key = (top[1], top[2], _letters(top[3]))
    if state in tops and (tops[state][1], tops[state][2], _letters(tops[state][3])) <= key:
        return False
    tops[state] = top
    return True


def _edited(top: Top, letter: str, symbol: str, cost: int) -> Top | None:
    stack = shift(top[0], symbol)
    given = None if letter == "K" else NAMES[symbol]
    return None if stack is None else (stack, top[1] + cost, top[2], (*top[3], (letter, given)))


def _with_inserts(tops: dict[int, Top]) -> dict[int, Top]:
    """The tops and all that inserted rows lead to from them."""
    found, todo = dict(tops), list(tops.values())
    while todo:
        top = todo.pop()
        for symbol in NAMES:
            new = _edited(top, "I", symbol, INSERT)
            if _merge(found, new):
                todo.append(new)
    return found


@functools.lru_cache(maxsize=65_536)
def advance(tops: tuple[tuple[Stack, int], ...], symbol: str, truncated: bool, must_go: bool) -> tuple[int, tuple[Top, ...]]:
    """One row: the least cost, and the new tops by the order of their audits, costs above the least.

    No top's audit is the beginning of another's: all end with an edit of the same row.
    """
    start: dict[int, Top] = {}
    for i, (stack, cost) in enumerate(tops):
        _merge(start, (stack, cost, i, ()))
    after: dict[int, Top] = {}
    extra = TRUNCATED if truncated else 0
    for top in _with_inserts(start).values():
        _merge(after, (top[0], top[1] + DELETE, top[2], (*top[3], ("D", None))))
        if not must_go:
            _merge(after, _edited(top, "K", symbol, extra))
            for other in NAMES:
                _merge(after, _edited(top, "R", other, REROLE + extra))
    least = min(t[1] for t in after.values())
    near = [t for t in after.values() if t[1] <= least + SLACK]
    near.sort(key=lambda t: (t[2], _letters(t[3])))
    return least, tuple((s, c - least, i, e) for s, c, i, e in near)


def finish(tops: tuple[tuple[Stack, int], ...]) -> tuple[int, int, Edits]:
    """After the last row: cost, number of the stack that wins, and the rows inserted at its end."""
    start: dict[int, Top] = {}
    for i, (stack, cost) in enumerate(tops):
        _merge(start, (stack, cost, i, ()))
    ends = [t for t in _with_inserts(start).values() if accepts(t[0])]
    _, cost, i, edits = min(ends, key=lambda t: (t[1], t[2], _letters(t[3])))
    return cost, i, edits


class Repair:
    """The parse of one conversation, row by row."""

    def __init__(self) -> None:
        self.tops: tuple[tuple[Stack, int], ...] = (((0,), 0),)
        # Of each top: edits since all tops parted, as (earlier edits, letters), and the digest of its text.
        self.paths: list[tuple | None] = [None]
        self.digests = [hashlib.sha256()]
        self.cost = 0
        self.agreed: list[str] = []

    @staticmethod
    def _written(digest, stack: Stack, edits: Edits, role: bytes, text: bytes):
        """The digest after the rows that the edits leave; the stack tells whether any stands before them."""
        digest = digest.copy()
        first = stack == (0,)
        for letter, given in edits:
            if letter != "D":
                digest.update(b"" if first else b"\n")
                digest.update(role if given is None else given.encode())
                digest.update(b":")
                digest.update(b"" if letter == "I" else text)
                first = False
        return digest

    def _agree(self, path: tuple | None) -> None:
        letters = []
        while path is not None:
            path, part = path
            letters.append(part)
        self.agreed.append("".join(reversed(letters)))

    def row(self, symbol: str, truncated: bool, must_go: bool, role: bytes, text: bytes) -> None:
        least, after = advance(self.tops, symbol, truncated, must_go)
        self.cost += least
        if len({i for _, _, i, _ in after}) == 1 and self.paths[after[0][2]] is not None:
            self._agree(self.paths[after[0][2]])
            self.paths[after[0][2]] = None
        digests, paths = [], []
        for _, _, i, edits in after:
            only_gone = all(letter == "D" for letter, _ in edits)
            old = self.digests[i]
            digests.append(old if only_gone else self._written(old, self.tops[i][0], edits, role, text))
            paths.append((self.paths[i], _letters(edits)))
        self.tops = tuple((s, c) for s, c, _, _ in after)
        self.digests, self.paths = digests, paths

    def result(self) -> tuple[int, str, str]:
        """Cost, audit, digest of the repaired rows."""
        cost, i, edits = finish(self.tops)
        self._agree((self.paths[i], _letters(edits)))
        digest = self._written(self.digests[i], self.tops[i][0], edits, b"", b"")
        return self.cost + cost, "".join(self.agreed), digest.hexdigest()


class Conversation:
    """What is known of a conversation after the rows read so far."""

    LEGAL = ("su", "ua", "au")

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.least = self.last = None  # turns
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None
        self.first: tuple | None = None
        self.repair = Repair()

    def mark_first(self, key: tuple) -> None:
        """The next row is the first of its role and text."""
        self.first = key

    def row(self, turn, key: tuple, symbol: str, role: bytes, text: bytes, blank: bool, cut: bool) -> None:
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.last
            self.last = turn
        if self.before is not None and self.before + symbol not in self.LEGAL:
            self.illegal += 1
        self.before = symbol
        again = not blank and self.first != key
        self.first = None
        cut = cut and not blank and not again
        self.blank += blank
        self.duplicate += again
        self.truncated += cut
        self.repair.row(symbol, cut, blank or again, role, text)

    def result(self) -> tuple:
        cost, audit, digest = self.repair.result()
        gaps = 0 if self.last is None else self.last - self.least + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest)


MARK, ROW = 0, 1  # kinds, in the order in which they stand
FIELDS = ("conv_id", "turn", "role", "digest", "kind", "text", "symbol", "blank", "cut")
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _repaired(batches: Iterator[pa.RecordBatch], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("conv_id", id_type), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())]
    )
    out: list[tuple] = []
    size = 0

    def packed() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    now: Conversation | None = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in FIELDS]
        for conv_id, turn, role, digest, kind, text, symbol, blank, cut in zip(*columns, strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    out.append(now.result())
                    size += len(out[-1][-2])
                    if len(out) >= OUT_ROWS or size >= OUT_BYTES:
                        yield packed()
                        out, size = [], 0
                now = Conversation(conv_id)
            if kind == MARK:
                now.mark_first((turn, role, digest))
            elif symbol is not None:  # rows that the damage took only say that there is a conversation
                now.row(turn, (turn, role, digest), symbol, role, text, blank, cut)
    if now is not None:
        out.append(now.result())
    if out:
        yield packed()


def _key_text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damaged(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, turn, role, text) after the damage; a row that it drops keeps null role and text.

    By the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 takes
    ``.``, ``!`` and ``?`` from it, 3 repeats it, 4 makes its role ``user``. A null counts as one space.
    """
    kind = F.crc32(F.concat(_key_text(F.col(conv_col)), F.lit(":"), _key_text(F.col(turn_col))).cast("binary")) % 20
    role, text = _key_text(F.col(role_col)), _key_text(F.col(text_col))
    hurt = rows.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        kind.alias("kind"),
        F.when(kind == 4, F.lit("user")).when(kind != 0, role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).when(kind != 0, text).alias("text"),
    )
    twice = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return hurt.withColumn("_copy", F.explode(twice)).select("conv_id", "turn", "role", "text")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text): its faults, and its cheapest repair.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    A row's first fault counts: blank (white space alone), duplicate (role and text stood
    earlier), truncated (the last character that is no white space is not ``.``, ``!`` or ``?``).
    Keep costs 0, Rerole 3, Delete 4 (required for blank and duplicate rows), Insert 3; a
    truncated row that stays costs 3 more. Of equally cheap audits the least by ASCII wins.

    Rows are read by turn, nulls first; rows of one turn by role and by the SHA-256 of their
    text, so the order of the input does not matter. A null id is a conversation of its own.
    Null text or role is one space. A role's letter is its first character; a role without one
    (empty) or with a letter outside the grammar cannot be kept. A row with null role and null
    text (what ``damaged`` leaves of a dropped row) only names its conversation; a conversation
    without other rows has zeros, an empty audit and the digest of an empty string. Whole
    texts count; equal rows count as often as they stand there. An empty table gives an
    empty table. Other columns are ignored.

    The digest of a conversation needs its rows in order, so one task streams through it; its
    memory holds the stacks and the audit, neither rows nor texts.
    """
    id_type = rows.schema["conv_id"].dataType
    gone = F.col("role").isNull() & F.col("text").isNull()
    role, text = _key_text(F.col("role")), _key_text(F.col("text"))
    trimmed = F.rtrim(text, F.lit(SPACE))
    seen = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(~gone, role).alias("role"),
        F.when(~gone, F.unhex(F.sha2(text, 256))).alias("digest"),
        F.lit(ROW).alias("kind"),
        F.when(~gone, text).cast("binary").alias("text"),
        F.when(~gone, F.substring(role, 1, 1)).alias("symbol"),
        (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    firsts = (
        seen.where(F.col("symbol").isNotNull() & ~F.col("blank"))
        .groupBy("conv_id", "role", "digest")
        .agg(F.when(F.count("turn") == F.count(F.lit(1)), F.min("turn")).alias("turn"))
        .select(
            "conv_id", "turn", "role", "digest", F.lit(MARK).alias("kind"), F.lit(None).cast("binary").alias("text"),
            F.lit(None).cast("string").alias("symbol"), F.lit(False).alias("blank"), F.lit(False).alias("cut"),
        )
    )
    # A blank row's text is not needed: it must go.
    lean = seen.withColumn("text", F.when(~F.col("blank"), F.col("text")))
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "digest", "kind"]
    met = firsts.unionByName(lean).withColumn("role", F.col("role").cast("binary"))
    dealt = met.repartition("conv_id").sortWithinPartitions(*order)
    numbers = ", ".join(f"{c} long" for c in COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            kind = first.schema.field("conv_id").type
            yield from _repaired(_chained(first, batches), kind)

    return dealt.mapInArrow(run, f"conv_id {id_type.simpleString()}, {numbers}, audit string, repaired_sha256 string")


def _chained(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def damage_and_repair(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``repair`` of the ``damaged`` rows; every conversation of the input has its row."""
    return repair(damaged(rows, conv_col, turn_col, role_col, text_col))
