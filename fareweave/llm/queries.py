"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareweave.llm import (
    bpe,
    conversations,
    embeddings,
    exact_dedup,
    html_extract,
    mixing,
    neighbours,
    records,
    sharding,
    simhash,
    token_counts,
    toxicity,
    whitening,
)
from fareweave.storage import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot and shard, on 32 shards."""
    return sharding.shard_documents(table(spark, sf_dir, "documents").select("doc_id"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded, with digests of both."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode_decode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what a mix of 150 % of all words takes of it."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mix_sizes(docs, mixing.cycled_weights(docs, cycle=(3, 1, 2)), share=1.5, most=2.0)


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, and whether they exceed 512."""
    docs = table(spark, sf_dir, "documents")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), budget=512)
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its equal texts."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint of 4-word shingles, and its component at 4 bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4, seed=42)


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links of cosine 0.95 or more, and its component."""
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op10_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as records of token ids, and read back from the files."""
    folder = scratch_path(spark, "records")
    docs = table(spark, sf_dir, "documents")
    records.write_records(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    starts = records.read_index(spark, folder).select("file", "row", "start")
    found = records.read_records(spark, folder, with_ids=False)
    return found.join(starts, ["file", "row"]).select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of each whose id is divisible by 20."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, most=20)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whitened along the 32 leading components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32)


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after the damage, and its cheapest repair."""
    return conversations.damage_and_repair(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_bpe": op2_bpe,
    "op3_mixing": op3_mixing,
    "op4_html": op4_html,
    "op5_toxicity": op5_toxicity,
    "op6_token_counts": op6_token_counts,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_simhash": op8_simhash,
    "op9_embeddings": op9_embeddings,
    "op10_records": op10_records,
    "op11_neighbours": op11_neighbours,
    "op12_whitening": op12_whitening,
    "op13_conversations": op13_conversations,
}
