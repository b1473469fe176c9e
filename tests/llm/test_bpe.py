import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from fareweave.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [
    None, "", " ", "a", "It's we'll they've I'd x'lb 'REx", "  two  spaces \n\n\nlines\t\ttabs \r\n", "aaaaaaaaaaaaaaaa" * 40,
    "!" * 501, "naïve café ÀÉ 日本語 テスト \U0001f600\U0001f468‍\U0001f469", "1234567890 ½ ² Ⅷ ٣٤", "\x00\x01\x1c\x1d mixed\x85nel ls",
    "<|endoftext|> is text", "Donaudampfschifffahrtselektrizitätenhauptbetriebswerkbauunterbeamtengesellschaft" * 3,
    " 　wide", "é combining", "under_score __init__", "\U0001fae8\U0001fadc new ౝ letters \U000323b0", "ab" * 300 + "ba" * 100,
]


def test_as_the_library(spark, library):
    docs = spark.createDataFrame(list(enumerate(TEXTS * 3)), "doc_id long, text string").selectExpr("*", "1 as ids", "2 as id")
    rows = bpe.encode_decode(docs.repartition(3), PATH, P.PATTERN).collect()
    assert len(rows) == 3 * len(TEXTS)
    for r in rows:
        text = TEXTS[r.doc_id % len(TEXTS)] or ""
        assert r.ids == library.encode_ordinary(text), text
        assert bytes(r.decoded) == text.encode()


def test_both_queries_agree(library):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdeéß日", k=rng.randint(2, 60))) for _ in range(300)] + ["a" * n for n in range(2, 40)]
    words = [w.encode() for w in words if w.encode() not in library._mergeable_ranks]
    coder = bpe.tokenizer(PATH, P.PATTERN)
    assert coder._contract(bpe.ENCODE, words) == coder._contract(bpe.ENCODE_LONG, words)


def test_every_token_is_reached_by_merges_of_lower_rank(library):
    """What the query for long pieces relies on."""
    coder = bpe.tokenizer(PATH, P.PATTERN)
    some = sorted(t for t in coder.ranks if len(t) > 1)[::7]
    got = coder._contract(bpe.ENCODE, some)
    assert [int.from_bytes(g, "little") if len(g) == 4 else None for g in got] == [coder.ranks[t] for t in some]


def test_long_texts_are_decoded_in_parts(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "ROWS_AT_ONCE", 1000)
    text = " ".join(f"word{i}" for i in range(3000))
    coder = bpe.RankTokenizer(PATH, P.PATTERN)
    ids = bpe.np.array(library.encode_ordinary(text))
    assert coder.decode(bpe.np.array([0, 0, len(ids)]), ids) == [b"", text.encode()]


def test_decode_alone(spark, library):
    rows = [(1, library.encode_ordinary("so it goes")), (2, []), (3, None)]
    out = bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH, P.PATTERN).collect()
    assert [bytes(r.decoded) for r in sorted(out, key=lambda r: r.doc_id)] == [b"so it goes", b"", b""]
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(spark.createDataFrame([(1, [99_999_999])], "doc_id long, ids array<int>"), PATH, P.PATTERN).collect()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(docs, PATH, P.PATTERN).count() == 0


def test_query(spark, library):
    from fareweave.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op2_bpe"](spark, folder).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_a_long_run_of_varied_letters(library):
    rng = random.Random(9)
    text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=10_000))
    coder = bpe.RankTokenizer(PATH, P.PATTERN)
    ids = bpe.np.frombuffer(coder.encode_pieces([text])[0], bpe.np.int32).tolist()
    assert ids == library.encode_ordinary(text)
