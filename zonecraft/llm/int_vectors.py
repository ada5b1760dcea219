"""Whole-number vectors in blocks: what the searches by exact inner product share.

Rows are numbered when they are first written, so equal ids and equal rows stay apart. Blocks are cut by rank in a global
order, so their number follows from the table's size alone, and equal vectors may lie in several blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecraft.llm.common import map_batches
from zonecraft.llm.neighbours import runs
from zonecraft.operators.running import number_rows

# Scaled components beyond this, which no longer are whole numbers of a double, are taken as this.
LARGEST = 2.0**53


def whole_vectors(table: DataFrame, scale: int, id_column: str, vector_column: str, label: Column | None = None) -> DataFrame:
    """``row, vec_id, label, norm, v``: v holds floor(scale * x) as little-endian longs.

    Rows whose vector is NULL or has NULL or non-finite components are left out. To be written before it is used twice.
    """
    plain = table.select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"),
        (F.lit(None) if label is None else label).cast("long").alias("label"),
        F.col(f"`{vector_column}`").cast("array<double>").alias("x"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            lists = batch.column(2)
            there = np.asarray(lists.is_valid())
            sizes = np.nan_to_num(np.array(lists.value_lengths().to_numpy(zero_copy_only=False), float)).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
            ends = np.cumsum(sizes)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            kept = np.flatnonzero(there & (bad[ends] == bad[ends - sizes]))
            scaled = np.clip(np.floor(np.where(np.isfinite(flat), flat, 0) * scale), -LARGEST, LARGEST)
            whole = scaled.astype("<i8")
            spans = [(ends[i] - sizes[i], ends[i]) for i in kept]
            chosen = pa.array(kept)
            yield {
                "row": np.arange(row, row + len(kept)),
                "vec_id": batch.column(0).take(chosen),
                "label": batch.column(1).take(chosen),
                # Each norm by itself: a difference of running sums would lose small vectors beside large ones.
                "norm": [float(np.sqrt(np.dot(scaled[a:b], scaled[a:b]))) for a, b in spans],
                "v": [whole[a:b].tobytes() for a, b in spans],
            }
            row += len(kept)

    return map_batches(plain, "row long, vec_id long, label long, norm double, v binary", work)


def in_blocks(rows: DataFrame, order: list[str | Column], size: int, into: str) -> DataFrame:
    """Add ``into``: the rank in ``order`` (unique) divided by ``size``, from 0."""
    keys = rows.drop("v")
    placed = number_rows(keys, [], order, "_place").select("row", F.floor((F.col("_place") - 1) / size).cast("long").alias(into))
    return rows.join(placed, "row")


def phases(blocks: int, first: int) -> Iterator[tuple[int, int]]:
    """Ranges of block numbers, each eight times the one before: what the first ones find narrows the later ones."""
    start, end = 0, first
    while start < blocks:
        yield start, min(end, blocks)
        start, end = end, end * 8


def matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), size)


def product_kind(left: np.ndarray, right: np.ndarray) -> type:
    """The cheapest number type that holds every product of two rows, given their norms, exactly."""
    largest = float(left.max(initial=0)) * float(right.max(initial=0)) * (1 + 1e-9)
    return np.float64 if largest < 2.0**53 else np.int64 if largest < 2.0**63 else object


def as_longs(scores: np.ndarray) -> np.ndarray:
    """Exact scores as longs; those that do not fit are set to the end of the range."""
    if scores.dtype == object:
        return np.array([min(max(int(s), -(2**63)), 2**63 - 1) for s in scores], np.int64)
    return scores.astype(np.int64)


def best_first(scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray, count: int) -> np.ndarray:
    """Positions of the ``count`` highest scores, ties to smaller ids, NULL ids last."""
    if len(scores) > 4 * count:
        least = np.partition(scores, len(scores) - count)[len(scores) - count]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    # Scores may be longs at the end of their range, so they are not negated but read backwards.
    order = np.lexsort((ids[at], nulls[at]))
    order = order[::-1][np.argsort(scores[at][order][::-1], kind="stable")][::-1]
    return at[order[:count]]


class Rows:
    """One side of a unit: a slice of a table as arrays."""

    def __init__(self, table: pa.Table, size: int):
        self.table = table
        self.row = table.column("row").to_numpy()
        self.norm = table.column("norm").to_numpy()
        self.nulls = np.asarray(table.column("vec_id").is_null().combine_chunks())
        self.ids = table.column("vec_id").fill_null(0).to_numpy()
        self.x = matrix(table.column("v"), size)

    def numbers(self, name: str) -> np.ndarray:
        return self.table.column(name).to_numpy()

    def lists(self, name: str) -> list:
        return self.table.column(name).to_pylist()

    def __len__(self) -> int:
        return len(self.row)


def meet(candidates: DataFrame, queries: DataFrame, pairs: DataFrame, order: str, schema: str, work: Callable) -> DataFrame:
    """``work(candidates, queries)`` for each pair of a ``bucket`` of candidates and a ``block`` of queries.

    A unit holds one bucket and one block, both of bounded size; queries are sorted by ``order``.
    """
    from_bucket = candidates.join(pairs, "bucket").withColumn("_side", F.lit(0)).withColumn("_at", F.col("row"))
    from_block = queries.join(pairs, "block").withColumn("_side", F.lit(1)).withColumn("_at", F.col(order).cast("long"))
    both = from_bucket.unionByName(from_block, allowMissingColumns=True)
    units = both.repartition("bucket", "block").sortWithinPartitions("bucket", "block", "_side", "_at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for table, starts in runs(batches, ["bucket", "block"]):
            side = table.column("_side").to_numpy()
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                middle = a + int(np.searchsorted(side[a:b], 1))
                if a < middle < b:
                    size = len(table.column("v")[a].as_py()) // 8
                    yield from work(Rows(table.slice(a, middle - a), size), Rows(table.slice(middle, b - middle), size))

    return map_batches(units, schema, run)
