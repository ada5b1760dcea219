"""The corpus pipeline: quality rules, near duplicates, secrets, mixing and packing, each on what the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``. ``run``
writes each result as Parquet to the shared folder and reads it again for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonecraft.llm import mixing, ngram_join, packing, quality_rules, secrets
from zonecraft.llm.common import Stages, prepare, read_table


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the classifier reject go."""
    return quality_rules.kept_documents(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    prepare(spark)
    return ngram_join.keep_one_per_component(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; no document goes."""
    return secrets.without_secrets(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stands as often as the mix of sources takes it."""
    prepare(spark)
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences along the curve."""
    prepare(spark)
    return packing.pack(docs, "byte_bpe_50k.json")


STAGES = [
    ("quality rules", quality_rules_stage),
    ("n-gram Jaccard join", near_duplicates_stage),
    ("secret scans", secrets_stage),
    ("mixing sources to target weights", mixing_stage),
    ("packing", packing_stage),
]

# The classifier of the first stage and the order along the curve of the last one can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = Stages(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stages.write(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
