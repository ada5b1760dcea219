"""A bounded sample of labelled documents, for the operators that learn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 4
HELD_OUT = 2


def fold(doc_id: Column) -> Column:
    """CRC-32 of the id as text, modulo ``FOLDS``; NULL for rows without an id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``doc_id, text, label``: at most ``rows`` rows outside the held-out fold, the first ones by a hash of the id.

    Labels that are NULL or neither 0 nor 1, and labels of documents that are not there, are left out before the rows are
    counted. Where an id has several labels, each is a row; where it stands on several rows, the smallest text counts.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("label"))
    known = known.where("label in (0, 1)").where(fold(F.col("_id")) != HELD_OUT).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    there = texts.select(F.col("doc_id").alias("_id")).distinct()
    chosen = known.join(there, "_id", "left_semi").orderBy(F.xxhash64("_id"), "_id", "label").limit(rows)
    # The limit above bounds what is sent to every task, the grouping below what comes back.
    found = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")
