import base64
import hashlib

import corpus_pipeline
import duckdb
import public_tokenizers as P
import pyarrow as pa
import tiktoken
from fareweave.llm import toxicity
from fareweave.llm.oracle import ORACLES
from test_simhash import brute, plain

FOLDER = "/root/testdata/sf0.001"


def test_against_brute_force(spark):
    """Each stage once more, in plain Python over all rows; the toxicity model is shared."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    rows = [r.asDict() for r in docs.collect()]
    clean = [
        r for r in rows if model.score(toxicity.features_of(*toxicity.find_hits(r["text"] or "", model.lexicon))) < 0.3
    ]
    single = {}
    for r in sorted(clean, key=lambda r: r["doc_id"]):
        single[r["text"] or ""] = r
    single = list(single.values())
    ids = [r["doc_id"] for r in single]
    roots = brute(ids, [plain(r["text"]) for r in single], 4)
    apart = [r for r, c in zip(single, roots, strict=True) if r["doc_id"] == c]
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist(apart))
    mixed = {i: n for i, n in con.execute(f"SELECT doc_id, copies FROM ({ORACLES['op3_mixing']})").fetchall()}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for r in apart:
        coded = library.encode_ordinary(r["text"] or "")
        digest = hashlib.sha256((r["text"] or "").encode()).hexdigest()
        expected += [(r["doc_id"], r["source"], tuple(coded), digest)] * mixed[r["doc_id"]]
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted((r.doc_id, r.source, tuple(r.ids), r.decoded_sha256) for r in got) == sorted(expected)
    assert all(r.n_tokens == len(r.ids) for r in got)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == 0


def test_nulls_in_every_column(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40)
    nothing = docs.selectExpr(*[f"cast(null as {t}) as {c}" for c, t in docs.dtypes])
    both = docs.unionByName(nothing)
    for _, stage in corpus_pipeline.STAGES:
        both = stage(spark, both, FOLDER)
        both = spark.createDataFrame(both.collect(), both.schema)
        assert both.count() > 0
