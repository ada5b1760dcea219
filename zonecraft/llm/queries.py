"""The registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecraft.llm import (
    hard_negatives,
    inner_products,
    mixing,
    neighbours,
    ngram_join,
    oracles,
    packing,
    quality_ranking,
    quality_rules,
    records,
    secrets,
    suffix_repeats,
    token_counts,
    whitening,
)
from zonecraft.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op4_suffix_repeats": oracles.SUFFIX_REPEATS,
    "op5_ngram_join": oracles.NGRAM_JOIN,
}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), "byte_bpe_50k.json")


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_report(read_table(spark, sf_dir, "documents"), "word_bpe_49k.json")


@query
def op3_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.record_report(read_table(spark, sf_dir, "documents"), "word_bpe_49k.json")


@query
def op4_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_repeats.remove_repeats(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(read_table(spark, sf_dir, "documents"))


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix_sources(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


@query
def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(read_table(spark, sf_dir, "embeddings"), k=10, every=100)


@query
def op8_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ranking.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_report(read_table(spark, sf_dir, "documents"))
    digest = F.sha2("base_spans", 256).alias("base_sha256")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", digest, "spans")


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *counts, "base_failed", "kept", "probability")


@query
def op11_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inner_products.top_products(read_table(spark, sf_dir, "embeddings"), k=10, every=100)


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"), count=8)


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"), every=100, label=noisy)
