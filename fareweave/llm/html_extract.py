"""The main text of pages, by a graphical model over the tree of the page.

Every block element and text block is a node that is main text or not. A node has a
potential from what it is (name, words of its attributes, length, links); each child and
parent share a potential for the four combinations of their states. The tree has no
loops, so one pass of sum-product messages from the leaves up and one down give exact
marginals. Text blocks whose marginal is over one half are the main text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareweave.llm.dom import Page, attributes, parse
from fareweave.llm.labelled_pages import labelled_pages

NODES_AT_ONCE = 200_000
ELEMENT, LEAF = 0, 1
NAME = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def element_features(tag: str, attrs: str) -> list[str]:
    """What an element's name and attributes tell."""
    out = [f"tag {tag}"]
    if attrs:
        told = attributes(attrs)
        for key in ("class", "id", "role"):
            if told.get(key):
                out += [f"name {w}" for w in NAME.findall(CAMEL.sub(" ", told[key]).lower()) if len(w) > 1]
        if "hidden" in told or told.get("aria-hidden") == "true" or HIDDEN.search(told.get("style", "")):
            out.append("hidden")
    return list(dict.fromkeys(out))


def leaf_features(text: str, linked: int, tag: str) -> list[str]:
    """What a text block's shape tells."""
    words = text.count(" ") + 1
    out = ["leaf", f"words {min(words.bit_length(), 6)}", f"links {round(4 * linked / len(text))}", f"in {tag}"]
    if text[-1] in ".!?…。":
        out.append("ends a sentence")
    if "©" in text[:80]:
        out.append("copyright")
    return out


@dataclass
class PageModel:
    """Weights of features, and potentials by kind of the child, state of the parent and state of the child."""

    weights: dict[str, float]
    potentials: np.ndarray
    known: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"weights": self.weights, "potentials": self.potentials, "known": {}}

    def node(self, tag: str, attrs: str) -> float:
        """The sum of an element's weights."""
        key = (tag, attrs)
        if key not in self.known:
            if len(self.known) > 50_000:
                self.known.clear()
            self.known[key] = sum(self.weights.get(f, 0.0) for f in element_features(tag, attrs))
        return self.known[key]

    def evidence(self, page: Page) -> list[float]:
        """The potential of each node of a page for being main text."""
        out = []
        for parent, tag, attrs, text, linked in zip(
            page.parent, page.tag, page.attrs, page.text, page.linked, strict=True
        ):
            if text is None:
                out.append(self.node(tag, attrs))
            else:
                out.append(sum(self.weights.get(f, 0.0) for f in leaf_features(text, linked, page.tag[parent])))
        return out


def propagate(
    parent: np.ndarray, kind: np.ndarray, evidence: np.ndarray, potentials: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Sum-product over a forest: each node's log belief in both states, and its parent's without the node's message.

    Parents come before their children; -1 is no parent. Depths are found by doubling the
    steps up; then each level sends its messages at once.
    """
    n = len(parent)
    up, depth = parent.copy(), (parent >= 0).astype(np.int64)
    while (up >= 0).any():
        moving = up >= 0
        above = up[moving]
        depth[moving], up[moving] = depth[moving] + depth[above], up[above]
    levels = np.split(np.argsort(depth, kind="stable"), np.cumsum(np.bincount(depth))[:-1]) if n else []
    belief, message, rest = np.zeros((n, 2)), np.zeros((n, 2)), np.zeros((n, 2))
    belief[:, 1] = evidence
    for level in levels[:0:-1]:
        joint = potentials[kind[level]] + belief[level][:, None, :]
        message[level] = np.logaddexp(joint[:, :, 0], joint[:, :, 1])
        np.add.at(belief, parent[level], message[level])
    for level in levels[1:]:
        rest[level] = belief[parent[level]] - message[level]
        joint = potentials[kind[level]] + rest[level][:, :, None]
        belief[level] += np.logaddexp(joint[:, 0], joint[:, 1])
    return belief, rest


def marginals(belief: np.ndarray) -> np.ndarray:
    """The probability of each node to be main text."""
    return 1.0 / (1.0 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -50, 50)))


def _labels(page: Page) -> tuple[np.ndarray, Page]:
    """The label of each node of a labelled page (an element: that of most of its text), and the page without labels."""
    plain, number, own = Page(), {}, {}
    label: list[int] = []
    for i, (parent, tag) in enumerate(zip(page.parent, page.tag, strict=True)):
        own[i] = {"x-main": 1, "x-rest": 0}.get(tag, own.get(parent, -1))
        if tag in ("x-main", "x-rest"):
            number[i] = number[parent]
            continue
        number[i] = plain.add(number.get(parent, -1), tag, page.attrs[i], page.text[i], page.linked[i])
        label.append(own[i])
    votes = np.zeros(len(label))
    for i in range(len(label) - 1, -1, -1):
        if plain.text[i] is not None:
            votes[i] = len(plain.text[i]) * (1 if label[i] == 1 else -1)
        if plain.parent[i] >= 0:
            votes[plain.parent[i]] += votes[i]
    return (votes > 0).astype(np.int64), plain


@lru_cache(maxsize=1)
def train(number: int = 480, steps: int = 200, ridge: float = 0.02) -> PageModel:
    """The model of greatest likelihood for ``number`` labelled pages, with a penalty on large weights.

    The gradient is what the labels count of each feature and pair, less what the
    messages expect of it; Adam follows it for ``steps`` steps.
    """
    at: dict[str, int] = {}
    nodes, features, parent, kind, label = [], [], [], [], []
    for source in labelled_pages(number):
        own, page = _labels(parse(source))
        first = len(label)
        for i, tag in enumerate(page.tag):
            text = page.text[i]
            above = page.parent[i]
            names = (
                element_features(tag, page.attrs[i])
                if text is None
                else leaf_features(text, page.linked[i], page.tag[above])
            )
            nodes += [first + i] * len(names)
            features += [at.setdefault(n, len(at)) for n in names]
            parent.append(first + above if above >= 0 else -1)
            kind.append(ELEMENT if text is None else LEAF)
        label += own.tolist()
    nodes, features, parent, kind, label = map(np.array, (nodes, features, parent, kind, label))
    child = np.flatnonzero(parent >= 0)
    size = len(at)

    def pair_sums(joint: np.ndarray) -> np.ndarray:
        return np.stack([joint[kind[child] == k].sum(axis=0) for k in (ELEMENT, LEAF)])

    truth = np.zeros((len(child), 2, 2))
    truth[np.arange(len(child)), label[parent[child]], label[child]] = 1.0
    truth = pair_sums(truth)
    theta, mean, square = np.zeros(size + 8), np.zeros(size + 8), np.zeros(size + 8)
    for step in range(1, steps + 1):
        potentials = theta[size:].reshape(2, 2, 2)
        evidence = np.bincount(nodes, theta[features], len(label))
        belief, rest = propagate(parent, kind, evidence, potentials)
        p = marginals(belief)
        # Without the message from above: what the child's own side says.
        down = potentials[kind[child]] + rest[child][:, :, None]
        below = belief[child] - np.logaddexp(down[:, 0], down[:, 1])
        joint = down + below[:, None, :]
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        gradient = np.concatenate(
            [np.bincount(features, (label - p)[nodes], size), (truth - pair_sums(joint)).ravel()]
        )
        gradient -= ridge * number * 0.05 * theta
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        rate = 0.15 * (1 - step / (steps + 1))
        theta += rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights = {name: float(theta[i]) for name, i in at.items()}
    return PageModel(weights, theta[size:].reshape(2, 2, 2).copy())


def main_texts(sources: list[str], model: PageModel) -> list[str]:
    """The main text of each page: its blocks in page order, joined by empty lines."""
    out: list[str] = []
    first = 0
    while first < len(sources):
        pages: list[Page] = []
        starts, nodes = [], 0
        while first + len(pages) < len(sources) and (not pages or nodes < NODES_AT_ONCE):
            starts.append(nodes)
            pages.append(parse(sources[first + len(pages)]))
            nodes += len(pages[-1].parent)
        first += len(pages)
        parents = [np.array(p.parent, dtype=np.int64) for p in pages]
        parent = np.concatenate([np.where(p < 0, p, p + s) for p, s in zip(parents, starts, strict=True)])
        kind = np.array([ELEMENT if t is None else LEAF for p in pages for t in p.text], dtype=np.int64)
        evidence = np.array([e for p in pages for e in model.evidence(p)])
        main = marginals(propagate(parent, kind, evidence, model.potentials)[0]) > 0.5
        for page, start in zip(pages, starts, strict=True):
            texts = [t for i, t in enumerate(page.text) if t is not None and main[start + i]]
            out.append("\n\n".join(texts))
    return out


def extract(
    pages: DataFrame, model: PageModel | None = None, html_col: str = "html", text_col: str = "text"
) -> DataFrame:
    """``pages`` without its html, with the main text of each page.

    The text is empty for a null or empty page and where nothing is main text. Nothing
    of a block is cut, however long. A column named as ``text_col`` is replaced; other
    columns stay. An empty table gives an empty table. ``model`` defaults to the one
    trained on the labelled pages, which is a few hundred numbers.
    """
    model = model or train()
    columns = [c for c in pages.columns if c not in (html_col, text_col)]
    names = [f"c{i}" for i in range(len(columns))]
    types = dict(pages.dtypes)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = [s or "" for s in batch.column(batch.num_columns - 1).to_pylist()]
            texts = pa.array(main_texts(sources, model), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], [*names, "text"])

    schema = ", ".join([*(f"{n} {types[c]}" for n, c in zip(names, columns, strict=True)), "text string"])
    given = pages.select(*[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)], F.col(html_col).alias("html"))
    out = given.mapInArrow(compute, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, columns, strict=True)], F.col("text").alias(text_col))
