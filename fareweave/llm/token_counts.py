"""Exact token counts of every prefix of a text, by dynamic programming over prefixes.

For a byte-level BPE, every prefix of a piece has one encoding, and its last token is the
only token that ends there and may follow the encoding of what comes before it. So the
tables grow byte by byte: last token and count of a prefix come from those of a shorter
one. Two tokens may stand side by side if no merge across their border would have come
before the merges that built them. Distinct pieces are handled in sorted order, and a
piece keeps the table of the prefix it shares with the one before.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareweave.llm.library import byte_letters, settings
from fareweave.llm.words import BYTE_LEVEL, PieceCache, coded_pieces, free_memory, piece_lists, split_texts

NEVER = 1 << 62
CACHED_PAIRS = 400_000
SPACE = regex.compile(r"\s+")
SPLIT_CLITICS = ("'re", "'ve", "'ll")  # fixed values: what the pattern takes as one piece of three characters


class PrefixCounter:
    """Prefix tables for the pieces of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        pattern, special, _ = settings(path)
        if told["model"]["type"] != "BPE" or pattern != BYTE_LEVEL or told["model"].get("ignore_merges"):
            raise ValueError(f"not a byte-level BPE with merges alone: {path}")
        letters = byte_letters()
        vocab = {t: i for t, i in told["model"]["vocab"].items() if all(c in letters for c in t)}
        self.tokens = {bytes(letters[c] for c in t): i for t, i in vocab.items()}
        self.longest = max(map(len, self.tokens))
        self.merges: dict[tuple[int, int], int] = {}
        self.built: dict[int, tuple[int, int, int]] = {}  # token: left, right, rank
        for rank, merge in enumerate(told["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = vocab[left], vocab[right]
            self.merges[a, b] = rank
            self.built.setdefault(vocab[left + right], (a, b, rank))
        self.pattern = regex.compile(pattern)
        self.special_texts = set(special)
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.cache = PieceCache(self.learn)
        self.fits: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.right_edges: dict[int, list[tuple[int, int]]] = {}
        self.left_edges: dict[int, list[tuple[int, int]]] = {}

    def _edge(self, token: int, side: int, known: dict[int, list[tuple[int, int]]]) -> list[tuple[int, int]]:
        """The tokens at one edge of a token's merge tree, each with the rank at which it is merged into the next."""
        if token not in known:
            out, at, until = [], token, NEVER
            while True:
                out.append((at, until))
                if at not in self.built:
                    break
                until = self.built[at][2]
                at = self.built[at][side]
            known[token] = out
        return known[token]

    def _border_holds(self, left: int, right: int, until: int = NEVER) -> bool:
        """No merge across the border of two tokens comes before both sides are built, and none below ``until`` after that.

        Of equal pairs the left one is merged first: a token that is taken up on the left
        by the same merge is gone, one on the right is not yet.
        """
        merges = self.merges
        for y, y_until in self._edge(right, 0, self.left_edges):
            for x, x_until in self._edge(left, 1, self.right_edges):
                rank = merges.get((x, y))
                if rank is not None and rank < min(x_until, until) and rank <= y_until:
                    return False
        return True

    def _is_whole(self, token: int) -> bool:
        """Whether a token's bytes are encoded as that token."""
        if token not in self.whole:
            if token in self.built:
                left, right, rank = self.built[token]
                self.whole[token] = (
                    self._is_whole(left) and self._is_whole(right) and self._border_holds(left, right, rank)
                )
            else:
                self.whole[token] = len(self.bytes_of[token]) == 1
        return self.whole[token]

    @property
    def bytes_of(self) -> dict[int, bytes]:
        if not hasattr(self, "_bytes_of"):
            self._bytes_of = {i: t for t, i in self.tokens.items()}
        return self._bytes_of

    def _may_follow(self, last: int, token: int) -> bool:
        key = last << 32 | token
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > CACHED_PAIRS:
                self.fits.clear()
            known = self.fits[key] = self._is_whole(token) and self._border_holds(last, token)
        return known

    def learn(self, pieces: list[str]) -> list[bytes]:
        """For each piece, the token counts of its prefixes of 1, 2, ... characters, as 32-bit integers."""
        out: dict[str, bytes] = {}
        tokens, longest, fits, may_follow = self.tokens, self.longest, self.fits, self._may_follow
        last, counts, before = [-1], [0], b""
        for piece in sorted(pieces):
            if piece in self.special_texts:
                out[piece] = array("i", [1] * len(piece)).tobytes()
                continue
            word = piece.encode()
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :], counts[shared + 1 :]
            before = word
            for end in range(shared + 1, len(word) + 1):
                for start in range(max(0, end - longest), end):
                    token = tokens.get(word[start:end])
                    if token is None:
                        continue
                    if start:
                        previous = last[start]
                        good = fits.get(previous << 32 | token)
                        if good is None:
                            good = may_follow(previous, token)
                    else:
                        good = self._is_whole(token)
                    if good:
                        last.append(token)
                        counts.append(counts[start] + 1)
                        break
                else:
                    raise ValueError("the vocabulary does not cover all bytes")
            if len(word) == len(piece):
                out[piece] = array("i", counts[1:]).tobytes()
            else:
                chars = [c for i, c in enumerate(counts[1:], 1) if i == len(word) or word[i] & 0xC0 != 0x80]
                out[piece] = array("i", chars).tobytes()
        return [out[p] for p in pieces]

    def split(self, text: str) -> list[str]:
        """The pieces of a text; a special string is a piece."""
        if not self.special:
            return self.pattern.findall(text)
        out, at = [], 0
        for found in self.special.finditer(text):
            out += [*self.pattern.findall(text, at, found.start()), found.group()]
            at = found.end()
        return out + self.pattern.findall(text, at)

    def count(self, text: str) -> int:
        """The tokens of a text, from the tables."""
        return sum(int.from_bytes(v[-4:], "little") for v in self.cache.values(self.split(text)))

    def prefix_counts(self, text: str) -> np.ndarray:
        """The tokens of each prefix of a text of 1, 2, ... characters.

        A prefix that ends within a piece adds the piece's own table to the count before
        it. Where the cut changes how the end is split (white space that loses what
        follows it, a clitic or a special string that is not complete), that end is split anew.
        """
        out = np.zeros(len(text), dtype=np.int64)
        at, base, back = 0, 0, ""
        pieces = self.split(text)
        for piece, value in zip(pieces, self.cache.values(pieces), strict=True):
            table = np.frombuffer(value, np.int32)
            out[at : at + len(piece)] = base + table
            space = SPACE.match(piece)
            if piece in self.special_texts:
                for cut in range(1, len(piece)):
                    out[at + cut - 1] = self.count(text[: at + cut])
            elif piece in SPLIT_CLITICS:
                out[at + 1] = base + self.count(piece[:2])
            elif back and space:
                start = at - len(back)
                earlier = int(out[start - 1]) if start else 0
                for cut in range(1, space.end() + 1):
                    out[at + cut - 1] = earlier + self.count(back + piece[:cut])
            back = piece if space and space.end() == len(piece) else ""
            at += len(piece)
            base += int(table[-1])
        return out

    def longest_within(self, text: str, budget: int) -> int:
        """The length of the longest prefix with at most ``budget`` tokens."""
        within = np.flatnonzero(self.prefix_counts(text) <= budget)
        return int(within[-1]) + 1 if len(within) else 0


_LOADED: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """The worker's counter for a file."""
    if path not in _LOADED:
        _LOADED[path] = PrefixCounter(path)
    return _LOADED[path]


def _within(coder: PrefixCounter, lists: pa.ListArray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """For each list of pieces: the tokens, and the characters of the longest prefix with at most ``budget``."""
    bounds, distinct, values, at = coded_pieces(lists, coder.cache)
    tokens = np.array([int.from_bytes(v[-4:], "little") for v in values], dtype=np.int64)
    chars = np.array([len(d) for d in distinct], dtype=np.int64)
    token_ends = np.concatenate([[0], np.cumsum(tokens[at])])
    char_ends = np.concatenate([[0], np.cumsum(chars[at])])
    # Pieces whose cuts may change how what stands before them is split.
    spaces = np.array([bool(SPACE.fullmatch(d)) for d in distinct], dtype=bool)
    odd = np.array([d in coder.special_texts or d in SPLIT_CLITICS for d in distinct], dtype=bool)
    totals = np.diff(token_ends[bounds])
    within = np.diff(char_ends[bounds])
    for row in np.flatnonzero(totals > budget).tolist():
        first, end = int(bounds[row]), int(bounds[row + 1])
        # The first piece that goes beyond the budget.
        k = int(np.searchsorted(token_ends, token_ends[first] + budget, side="right")) - 1
        near = at[max(first, k - 1) : min(end, k + 2)]
        if odd[near].any() or spaces[near[: k + 1 - max(first, k - 1)]].any():
            within[row] = coder.longest_within("".join(distinct[i] for i in at[first:end]), budget)
            continue
        table = np.frombuffer(values[at[k]], np.int32) + (token_ends[k] - token_ends[first])
        fitting = np.flatnonzero(table <= budget)
        within[row] = char_ends[k] - char_ends[first] + (int(fitting[-1]) + 1 if len(fitting) else 0)
    return totals, within


def count_tokens(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    budget: int = 512,
    store: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_tokens, within_chars, and prefix_counts if they are to be stored.

    ``n_tokens`` is what the tokenizers library gives for the whole text without added
    tokens, ``within_chars`` the characters of the longest prefix that has at most
    ``budget`` tokens, and ``prefix_counts`` the exact count of each prefix of 1, 2, ...
    characters. Whoever has these need not encode again to cut a text or to plan a
    budget. ``path`` is a byte-level BPE of the library that all machines have. Null and
    empty texts have no bytes and no tokens. Other columns are not looked at. An empty
    table gives an empty table.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    pattern, special, _ = settings(path)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = counter(path)
        try:
            for batch in batches:
                for first, end, lists in piece_lists(batch, coder.split):
                    totals, within = _within(coder, lists, budget)
                    columns = [batch.column(c).slice(first, end - first) for c in ("id", "n_bytes")]
                    columns += [pa.array(totals, pa.int64()), pa.array(within, pa.int64())]
                    if store:
                        texts = ("".join(pieces) for pieces in lists.to_pylist())
                        columns.append(pa.array([coder.prefix_counts(t) for t in texts], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(columns, names)
        finally:
            coder.cache.known.clear()
            free_memory()

    names = ["id", "n_bytes", "n_tokens", "within_chars", *["prefix_counts"] * store]
    schema = f"id {kind}, n_bytes long, n_tokens long, within_chars long" + ", prefix_counts array<long>" * store
    split = split_texts(docs, id_col, text_col, pattern, special)
    return split.mapInArrow(compute, schema).select(F.col("id").alias(id_col), *names[1:])
