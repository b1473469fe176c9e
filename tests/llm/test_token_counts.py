import numpy as np
import public_tokenizers as P
import pytest
from fareweave.llm import token_counts as C
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

PATH = P.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def tokens(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


TEXTS = [
    "It's we'll they've 're x'lb", "a  b   c \n\n\nd\t\te", "  lead and trail   ", "aaaaaaaaaaaaaaaaaaaaa!!!!!!!!",
    "naïve 日本語 \U0001f600 é", "one <|endoftext|> two<|endoftext|><|endof", " !<|endoftext|>", "12 345 67890 ½",
    "Hello world, this is an ordinary sentence with words.", "\n \n x", "tu x\x85y\x1cz",
]


@pytest.mark.parametrize("text", TEXTS)
def test_every_prefix(text):
    counts = C.counter(PATH).prefix_counts(text)
    assert counts.tolist() == [tokens(text[:k]) for k in range(1, len(text) + 1)]


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from(list("abcethino '!<|>\n\t  s.lérv12")), max_size=25))
def test_any_text(text):
    counts = C.counter(PATH).prefix_counts(text)
    assert counts.tolist() == [tokens(text[:k]) for k in range(1, len(text) + 1)]


def test_operator(spark):
    rows = list(enumerate([*TEXTS, None, "", "word " * 30_000, "x" * 20_000])) + [(None, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_tokens", "2 as id", "3 as pieces")
    got = C.count_tokens(docs, PATH, budget=7, store=True).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        text = texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), tokens(text))
        assert len(r.prefix_counts) == len(text) and (not text or r.prefix_counts[-1] == r.n_tokens)
        fits = np.flatnonzero(np.array(r.prefix_counts, dtype=int) <= 7)
        assert r.within_chars == (int(fits[-1]) + 1 if len(fits) else 0)
    assert C.count_tokens(docs.limit(0), PATH).count() == 0


def test_query(spark):
    from fareweave.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op6_token_counts"](spark, folder).collect():
        n = tokens(texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        C.PrefixCounter(P.path("word_bpe_49k.json"))
