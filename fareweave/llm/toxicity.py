"""Toxicity from misspelled lexicon terms and the windows around them.

Terms are learned: beginnings of words that stand in toxic texts and hardly in others,
kept in a trie. A Levenshtein automaton runs over the trie, so a word is matched with all
terms at once, with up to two edits. A hit counts by its context window: within quotation
marks or after a word of reporting it is quotation; near a word of address, a mark of
exclamation or other hits it is abuse. A logistic model over the sums gives the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareweave.llm.words import free_memory, small_batches
from fareweave.storage import materialize

MAX_TRAINING_ROWS = 20_000  # labelled rows that the logistic model is fitted on, chosen by a hash of the id
SHORTEST, LONGEST = 3, 16  # letters of a term that is learned
LEAST = 5  # toxic texts that a term stands in
CHANCE = 0.01  # that any term at all stands in so many toxic texts by chance, at most
PURITY = 0.95  # share of toxic among the texts with a term
WINDOW = 8  # words to each side
NEAR = 80  # characters to each side in which quotation marks are sought
WORD = re.compile(r"\w+")
END = "\n"  # stands after the last letter of a term that is a whole word

# Words of reporting and of address in the languages of the corpus, marks.
REPORTING = frozenset(
    "said says say wrote writes called calls quoted quote reported claims claimed sagte sagt schrieb nannte zitierte "
    "dit disait écrit appelé cité dijo dice escribió llamó citó".split()
)
ADDRESS = frozenset(
    "you your you're youre yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted ustedes".split()
)
OPENING = "\"“„«‹‘"
CLOSING = "\"”“»›’"
FEATURES = ["exact", "misspelled", "quoted", "density", "cluster", "addressed"]


def edits_allowed(length: int) -> int:
    """A term of under five letters must be exact; from nine on, two edits may differ."""
    return 0 if length < 5 else 1 if length < 9 else 2


@dataclass(frozen=True)
class Term:
    """A beginning of words, or a whole word; ``weight`` is how much its texts speak for toxicity, 1 at most."""

    text: str
    whole: bool
    weight: float = 1.0


@dataclass
class Lexicon:
    """Terms in a trie, and the automaton over it, whose states are made when they are first met.

    A state is a set of (node, edits so far) and the best match that needs no more
    letters. ``off`` holds (term, edits) that are not to count.
    """

    terms: list[Term]
    off: frozenset[tuple[int, int]] = frozenset()
    children: list[dict[str, int]] = field(default_factory=lambda: [{}], repr=False)
    reach: list[int] = field(default_factory=lambda: [0], repr=False)
    ends: list[list[int]] = field(default_factory=lambda: [[]], repr=False)

    def __post_init__(self) -> None:
        for number, term in enumerate(self.terms):
            node, most = 0, edits_allowed(len(term.text))
            self.reach[0] = max(self.reach[0], most)
            for letter in term.text:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.reach.append(0)
                    self.ends.append([])
                node = self.children[node][letter]
                self.reach[node] = max(self.reach[node], most)
            self.ends[node].append(number)
        self._reset()

    def __getstate__(self):
        return {"terms": self.terms, "off": self.off}

    def __setstate__(self, state):
        self.__init__(**state)

    def _reset(self) -> None:
        self.states: dict[tuple, int] = {}
        self.told: list[tuple] = []
        self.moves: list[dict[str, int]] = []
        self.words: dict[str, tuple[int, int] | None] = {}
        self.start = self._state({0: 0}, None)

    def forget(self) -> None:
        """End of a task: drop the states and words met in it."""
        self._reset()
        free_memory()

    def _state(self, places: dict[int, int], best: tuple[int, int] | None) -> int:
        """The number of a state: places (node, least edits), closed under letters that the word lacks."""
        todo = list(places.items())
        while todo:
            node, edits = todo.pop()
            if places[node] < edits:
                continue
            for child in self.children[node].values():
                if edits + 1 <= self.reach[child] and places.get(child, 99) > edits + 1:
                    places[child] = edits + 1
                    todo.append((child, edits + 1))
        for node, edits in places.items():
            for number in self.ends[node]:
                if not self.terms[number].whole:
                    best = self._better(best, edits, number)
        # Nothing that costs as much as the best match so far can improve it.
        kept = frozenset((n, e) for n, e in places.items() if best is None or e < best[0])
        key = (kept, best)
        if key not in self.states:
            self.states[key] = len(self.told)
            self.told.append(key)
            self.moves.append({})
        return self.states[key]

    def _better(self, best: tuple[int, int] | None, edits: int, number: int) -> tuple[int, int] | None:
        if edits > edits_allowed(len(self.terms[number].text)) or (number, edits) in self.off:
            return best
        return (edits, number) if best is None or (edits, number) < best else best

    def _move(self, state: int, letter: str) -> int:
        places: dict[int, int] = {}

        def reached(node: int, edits: int) -> None:
            if edits <= self.reach[node] and places.get(node, 99) > edits:
                places[node] = edits

        kept, best = self.told[state]
        for node, edits in kept:
            reached(node, edits + 1)  # a letter too many
            for other, child in self.children[node].items():
                reached(child, edits + (other != letter))
        return self._state(places, best)

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term) of the nearest term that the word is or begins with; None without one."""
        if word in self.words:
            return self.words[word]
        if len(self.told) > 50_000 or len(self.words) > 150_000:
            self._reset()
        state, moves = self.start, self.moves
        for letter in word:
            after = moves[state].get(letter)
            if after is None:
                after = moves[state][letter] = self._move(state, letter)
            state = after
            if not self.told[state][0]:
                break
        kept, best = self.told[state]
        for node, edits in kept:
            for number in self.ends[node]:
                best = self._better(best, edits, number)
        self.words[word] = best
        return best


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


@dataclass(frozen=True)
class Hit:
    begin: int
    end: int
    term: str
    edits: int
    quoted: bool
    addressed: bool
    at: int  # word number
    weight: float = 1.0  # of the term


def find_hits(text: str, lexicon: Lexicon) -> tuple[list[Hit], int]:
    """The hits of a text with their context, and its number of words."""
    lowered = text.lower()
    words = WORD.findall(lowered)
    match, known = lexicon.match, lexicon.words
    found = {}
    for w in set(words):
        best = known[w] if w in known else match(w)
        if best is not None:
            found[w] = best
    if not found:
        return [], len(words)
    # Lowering may change the length of a text; spans are those of the text itself then.
    source = lowered if len(lowered) == len(text) else text
    hits = []
    for at, span in enumerate(WORD.finditer(source)):
        word = span.group().lower()
        if word not in found:
            continue
        edits, number = found[word]
        term = lexicon.terms[number]
        window = words[max(0, at - WINDOW) : at + WINDOW + 1]
        left = text[max(0, span.start() - NEAR) : span.start()]
        right = text[span.end() : span.end() + NEAR]
        opened = max(left.rfind(c) for c in OPENING)
        marks = opened >= 0 and any(c in right for c in CLOSING) and left[opened:].count('"') % 2 == (left[opened] == '"')
        reported = bool(REPORTING.intersection(words[max(0, at - WINDOW) : at]))
        addressed = bool(ADDRESS.intersection(window)) or "!" in text[span.end() : span.end() + 3]
        hits.append(
            Hit(span.start(), span.end(), term.text, edits, marks or reported, addressed, at, term.weight)
        )
    return hits, len(words)


def features_of(hits: list[Hit], n_words: int) -> list[float]:
    """The sums that the logistic model sees, by name in FEATURES."""
    direct = [h for h in hits if not h.quoted]
    near = most = 0
    for i, h in enumerate(direct):
        while h.at - direct[near].at > 2 * WINDOW:
            near += 1
        most = max(most, i - near + 1)
    return [
        math.log1p(sum(h.weight for h in direct if h.edits == 0)),
        math.log1p(sum(h.weight for h in direct if h.edits > 0)),
        math.log1p(len(hits) - len(direct)),
        min(1.0, 20.0 * sum(h.weight for h in direct) / max(1, n_words)),
        math.log1p(most),
        math.log1p(sum(h.weight for h in direct if h.addressed)),
    ]


@dataclass
class ToxicityModel:
    """A lexicon, and the logistic model over FEATURES. Without labels of both kinds, all scores are ``base``."""

    lexicon: Lexicon
    weights: list[float]
    intercept: float

    def score(self, features: list[float]) -> float:
        z = self.intercept + sum(w * x for w, x in zip(self.weights, features, strict=True))
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, z))))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: the CRC-32 of the id as text, modulo 4, is 2. A null id counts as empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def _marked(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic): the largest label of each document that is not held out."""
    return (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )


def _texts(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """(text, toxic) of the documents in ``marked``, at most MAX_TRAINING_ROWS of them; equal texts once."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(marked), "doc_id")
    return rows.groupBy("text").agg(F.max("toxic").cast("int").alias("toxic"))


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic): all labelled documents that are not held out, equal texts once.

    Which document stands for equal texts, and its label, is decided on digests; texts are
    shuffled once, to meet their label. The plan is the same at every size.
    """
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    usable = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marked = materialize(_marked(labels), "toxicity-labels")
    narrow = usable.select("doc_id", digest.alias("_sha")).join(marked.hint("merge"), "doc_id")
    chosen = materialize(
        narrow.groupBy("_sha").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").cast("int").alias("toxic")), "toxicity-chosen"
    )
    texts = usable.select("doc_id", digest.alias("_sha"), F.coalesce("text", F.lit("")).alias("text"))
    met = texts.join(chosen.hint("merge"), ["doc_id", "_sha"])
    # Rows equal in id and text lie together after the join.
    return met.dropDuplicates(["doc_id", "_sha"]).select("text", "toxic")


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """(text, toxic): at most about ``max_rows`` labelled documents, equal texts once, none of them held out."""
    marked = _marked(labels)
    total = marked.count()
    share = min(1.0, max_rows / max(1, total))
    some = marked.where(F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1_000_003)) < share * 1_000_003)
    # At most max_rows ids and labels go to the documents.
    return materialize(_texts(docs, some), "toxicity-training")


def _word_counts(training: DataFrame) -> DataFrame:
    """(word, toxic, clean): in how many texts of each kind a word stands. The empty word stands in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 500):
                seen = {0: Counter(), 1: Counter()}
                part = batch.slice(first, 500)
                for text, toxic in zip(part.column("text"), part.column("toxic"), strict=True):
                    seen[int(toxic.as_py() == 1)].update({"", *words_of(text.as_py())})
                every = list(seen[0] | seen[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(every, pa.string()),
                        pa.array([seen[1][w] for w in every], pa.int64()),
                        pa.array([seen[0][w] for w in every], pa.int64()),
                    ],
                    ["word", "toxic", "clean"],
                )
        free_memory()

    counted = training.mapInArrow(count, "word string, toxic long, clean long")
    return counted.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _learn_terms(words: DataFrame, toxic_texts: int, clean_texts: int) -> list[Term]:
    """The terms: shortest beginnings that are pure, prolonged while most of their words go on with a few letters.

    A beginning must stand in LEAST toxic texts, be pure, and be so by more than chance:
    were its n texts drawn from all, k of them would be toxic with at most the probability
    exp(-n * KL(k / n, share of toxic texts)), which is held against CHANCE divided by the
    number of beginnings that are tried. The driver sees those that pass, the lexicon.
    """
    lengths = F.sequence(F.lit(SHORTEST), F.least(F.length("word"), F.lit(LONGEST)))
    beginnings = F.transform(lengths, lambda n: F.substring(F.col("word"), F.lit(1), n))
    whole = F.when(F.length("word") <= LONGEST, F.array(F.concat("word", F.lit(END)))).otherwise(F.array())
    tried = materialize(
        words.where(F.length("word") >= SHORTEST)
        .select(F.explode(F.concat(beginnings, whole)).alias("term"), "toxic", "clean")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") + F.col("clean") >= LEAST),
        "toxicity-beginnings",
    )
    k, c, share = F.col("toxic"), F.col("clean"), toxic_texts / (toxic_texts + clean_texts)
    divergence = k * F.log(k / ((k + c) * share)) + F.when(c > 0, c * F.log(c / ((k + c) * (1 - share)))).otherwise(0.0)
    rows = (
        tried.where((k >= LEAST) & (k >= PURITY * (k + c)) & (k > share * (k + c)))
        .where(divergence >= math.log(max(1, tried.count()) / CHANCE))
        .select("term", "toxic", "clean")
        .collect()
    )
    pure = {r["term"]: r["toxic"] for r in rows}
    # The odds that a text with the term is toxic, against those of any text; 1 for a term of all toxic texts alone.
    prior = clean_texts / toxic_texts
    most = math.log((toxic_texts + 0.5) / 0.5 * prior)
    weight = {r["term"]: min(1.0, math.log((r["toxic"] + 0.5) / (r["clean"] + 0.5) * prior) / most) for r in rows}
    longer: dict[str, list[str]] = {}
    for term in pure:
        longer.setdefault(term[:-1], []).append(term)
    terms, todo = set(), [t for t in pure if not any(t[:n] in pure for n in range(SHORTEST, len(t)))]
    while todo:
        term = todo.pop()
        # The few letters that nearly all words go on with; misspellings and endings scatter.
        main = [t for t in longer.get(term, []) if pure[t] >= 0.25 * pure[term]]
        if sum(pure[t] for t in main) >= 0.75 * pure[term]:
            todo += main
        else:
            terms.add(Term(term.rstrip(END), term.endswith(END), weight[term]))
    return sorted(terms, key=lambda t: (t.text, t.whole))


def _impure(words: DataFrame, lexicon: Lexicon) -> frozenset[tuple[int, int]]:
    """(term, edits) whose misspellings stand rather in texts that are not toxic."""

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, clean = Counter(), Counter()
            columns = (batch.column(c).to_pylist() for c in ("word", "toxic", "clean"))
            for word, t, c in zip(*columns, strict=True):
                best = lexicon.match(word)
                if best is not None and best[0]:
                    toxic[best] += t
                    clean[best] += c
            pairs = list(toxic)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([n for _, n in pairs], pa.int32()),
                    pa.array([e for e, _ in pairs], pa.int32()),
                    pa.array([toxic[p] for p in pairs], pa.int64()),
                    pa.array([clean[p] for p in pairs], pa.int64()),
                ],
                ["term", "edits", "toxic", "clean"],
            )

    sums = (
        words.mapInArrow(matched, "term int, edits int, toxic long, clean long")
        .groupBy("term", "edits")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where("clean > toxic")
    )
    return frozenset((r["term"], r["edits"]) for r in sums.collect())


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> ToxicityModel:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    The lexicon comes from all labelled rows, the weights from about ``max_rows`` of them.
    Rows that ``held_out`` names are not used; neither are labels of unknown documents,
    null labels or null ids. Of several labels of a document the largest counts. Texts
    alone are inputs. With labels of one kind only, every text scores that kind's
    smoothed share; without labels, every text scores 0.
    """
    with small_batches(docs.sparkSession):
        words = materialize(_word_counts(labelled_rows(docs, labels)), "toxicity-words")
    found = words.where("word = ''").first()
    toxic, clean = (found["toxic"], found["clean"]) if found else (0, 0)
    if not toxic or not clean:
        share = (toxic + 0.5) / (toxic + clean + 1.0) if found else 0.0
        odds = math.log(share / (1 - share)) if found else -40.0
        return ToxicityModel(Lexicon([]), [0.0] * len(FEATURES), odds)
    lexicon = Lexicon(_learn_terms(words, toxic, clean))
    lexicon = Lexicon(lexicon.terms, _impure(words, lexicon))
    training = training_rows(docs, labels, max_rows)
    kinds = {r[0] for r in training.select(F.col("toxic") == 1).distinct().collect()}
    for kind in {False, True} - kinds:  # so rare that the sample has none: its own rows join
        rare = _marked(labels).where((F.col("toxic") == 1) == F.lit(kind))
        training = training.union(training_rows(docs, rare, max_rows)).groupBy("text").agg(F.max("toxic").alias("toxic"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [features_of(*find_hits(t.as_py(), lexicon)) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, pa.list_(pa.float64())), batch.column("toxic").cast(pa.float64())], ["values", "label"]
            )

    with small_batches(docs.sparkSession):
        table = materialize(training.mapInArrow(extract, "values array<double>, label double"), "toxicity-features")
    table = table.select(array_to_vector("values").alias("features"), (F.col("label") == 1).cast("double").alias("label"))
    fitted = LogisticRegression(maxIter=30, regParam=0.002, standardization=False).fit(table)
    return ToxicityModel(lexicon, [float(w) for w in fitted.coefficients], float(fitted.intercept))


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, score from 0 to 1, and hits (spans in characters, term, edits, quoted).

    Null and empty texts have no hits and the score of such a text. Other columns are
    not looked at. An empty table gives an empty table.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    hit = pa.struct(
        [("begin", pa.int32()), ("end", pa.int32()), ("term", pa.string()), ("edits", pa.int32()), ("quoted", pa.bool_())]
    )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                scores, spans = [], []
                for text in batch.column("text"):
                    hits, n_words = find_hits(text.as_py() or "", model.lexicon)
                    scores.append(model.score(features_of(hits, n_words)))
                    spans.append(
                        [
                            {"begin": h.begin, "end": h.end, "term": h.term, "edits": h.edits, "quoted": h.quoted}
                            for h in hits
                        ]
                    )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(hit))],
                    ["id", "score", "hits"],
                )
        finally:
            model.lexicon.forget()

    schema = (
        f"id {kind}, score double, hits array<struct<begin:int,end:int,term:string,edits:int,quoted:boolean>>"
    )
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(compute, schema).withColumnRenamed("id", id_col)


def keep_clean(
    docs: DataFrame, model: ToxicityModel, limit: float = 0.3, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``limit``, with all their columns. Null and empty texts are scored too."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    types = dict(docs.dtypes)
    at = docs.columns.index(text_col)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                clean = [
                    model.score(features_of(*find_hits(t.as_py() or "", model.lexicon))) < limit
                    for t in batch.column(at)
                ]
                yield batch.filter(pa.array(clean, pa.bool_()))
        finally:
            model.lexicon.forget()

    given = docs.select(*[F.col(c).alias(n) for c, n in zip(docs.columns, names, strict=True)])
    schema = ", ".join(f"{n} {types[c]}" for c, n in zip(docs.columns, names, strict=True))
    kept = given.mapInArrow(compute, schema)
    return kept.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])
