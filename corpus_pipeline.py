"""A corpus pipeline: toxicity, exact and near copies, a mix of sources, token ids.

Each stage reads what its predecessor kept and is judged on that alone.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareweave.llm import bpe, exact_dedup, mixing, simhash, toxicity
from fareweave.llm.words import small_batches
from fareweave.storage import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more for toxicity go; the model learns from the labels that are not held out."""
    model = toxicity.train(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model, limit=0.3)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of at most 4 bits connect, the one with the least id stays."""
    return simhash.keep_one_of_each(docs, shingle=4, radius=4, seed=42)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weigh 3, 1, 2 in turn and share 150 % of all words; a document taken twice stands there twice."""
    return mixing.mix_documents(docs, mixing.cycled_weights(docs, cycle=(3, 1, 2)), share=1.5, most=2.0)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids, n_tokens, and the digest of the bytes that the ids decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    keyed = docs.select(F.struct("doc_id", "source").alias("key"), "text")
    coded = bpe.encode_decode(keyed, path, public_tokenizers.PATTERN, id_col="key")
    tokens = coded.select(
        "key.doc_id",
        "key.source",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
    with small_batches(spark):
        return materialize(tokens, "tokens")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", to_tokens),
]

# No SQL: models, fingerprints and merges. The tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
