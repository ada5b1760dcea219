"""Hard negatives: for each anchor and each of its nearest rows of the same label, rows of other labels that score nearly as high.

Scores are whole inner products. Anchors of like label and direction are put in one block and joined by a spanning tree of
smallest total edge length. A candidate of length |p| whose score at the parent lies between two bounds scores at the child
between the lower one less and the upper one plus ``edge length * |p|``; the tree's root hangs on the zero vector, at which
every score is 0. Walking down the tree, only candidates whose interval overlaps a window of the child are scored exactly,
the others go on with their wider interval. A window reaches from 30 to 90 per cent of a positive's score; buckets are
visited in phases, and once ten negatives of a window are known its lower end rises to the lowest of them.

Positives are found by exact products between blocks and buckets that share a label.

Rows with a NULL label, a NULL vector or NULL or non-finite components take no part, nor vectors of another length than most.
Rows without an id may be positives and negatives but no anchors; ties go to the smaller id, none last. Where an id stands on
several rows, each is a row of its own. Windows of a positive with a score below 0 are empty. An empty table gives no rows.
Only the id, the vector and the label are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecraft.llm.common import Stages, map_batches
from zonecraft.llm.inner_products import best_of, masked
from zonecraft.llm.int_vectors import Rows, as_longs, best_first, in_blocks, matrix, meet, phases, product_kind, whole_vectors
from zonecraft.llm.neighbours import directions, runs, usual_length

SCALE = 256
BUCKET = 8192
BLOCK = 512
CHUNK = 2048  # candidates walked through the tree at once
FIRST = 2  # buckets of the first phase
SIGNS = 10  # random directions whose signs bring like anchors together
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # per cent of the positive's score
SLACK = 1e-9


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows in the order in which the tree reaches them, the place of each one's parent in it (-1: root), edge lengths."""
    n = len(x)
    order, parent, length = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n)
    apart = np.sqrt((x * x).sum(1))
    length[0] = apart[0]
    near, place = np.full(n, np.inf), np.zeros(n, np.int64)
    waiting = np.ones(n, bool)
    at = 0
    for step in range(n):
        order[step] = at
        if step:
            parent[step], length[step] = place[at], near[at]
        waiting[at] = False
        d = np.sqrt(((x - x[at]) ** 2).sum(1))
        closer = waiting & (d < near)
        near[closer], place[closer] = d[closer], step
        if step + 1 < n:
            at = int(np.argmin(np.where(waiting, near, np.inf)))
    return order, parent, length


def with_trees(anchors: DataFrame) -> DataFrame:
    """Anchors of each block with their ``step`` in its tree, the ``parent`` step and the edge length ``apart``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for table, starts in runs(batches, ["block"]):
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                own = table.slice(a, b - a)
                x = matrix(own.column("v"), len(own.column("v")[0].as_py()) // 8).astype(float)
                order, parent, length = spanning_tree(x)
                yield {"row": own.column("row").to_numpy()[order], "step": np.arange(b - a), "parent": parent, "apart": length}

    placed = anchors.select("block", "row", "v").repartition("block").sortWithinPartitions("block", "row")
    return anchors.join(map_batches(placed, "row long, step long, parent long, apart double", work), "row")


def near_directions(anchors: DataFrame) -> DataFrame:
    """Add ``code``, the signs of products with fixed random directions."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(1), len(batch.column(1)[0].as_py()) // 8).astype(np.float32)
                signs = x @ directions(0, SIGNS, x.shape[1]) > 0
                yield {"row": batch.column(0), "code": signs @ (1 << np.arange(SIGNS, dtype=np.int64))}

    return anchors.join(map_batches(anchors.select("row", "v"), "row long, code long", work), "row")


def positives_unit(candidates: Rows, anchors: Rows, count: int) -> Iterator[dict]:
    kind = product_kind(candidates.norm, anchors.norm)
    x, y = anchors.x.astype(kind), candidates.x.astype(kind)
    mine, theirs = anchors.numbers("label"), candidates.numbers("label")
    found = []
    for label in np.unique(mine):
        at = np.flatnonzero(theirs == label)
        some = np.flatnonzero(mine == label)
        if len(at):
            scores = x[some] @ y[at].T
            for n, i in enumerate(some):
                other = at[candidates.row[at] != anchors.row[i]]
                own = as_longs(scores[n][candidates.row[at] != anchors.row[i]])
                best = best_first(own, candidates.ids[other], candidates.nulls[other], count)
                found.append((np.full(len(best), anchors.row[i]), candidates.ids[other[best]], candidates.nulls[other[best]], own[best]))
    if found:
        row, ids, nulls, scores = (np.concatenate(c) for c in zip(*found, strict=True))
        yield {"anchor": row, "vec_id": masked(ids, nulls), "score": scores}


def window(positive: int, low: int, high: int) -> tuple[int, int]:
    """The whole scores s with ``low * positive <= 100 s <= high * positive``; empty where the first exceeds the last."""
    return -(-low * positive // 100), high * positive // 100


def negatives_unit(candidates: Rows, anchors: Rows, count: int, low: int, high: int) -> Iterator[dict]:
    """Per anchor and window the ``count`` best candidates of the bucket in it, found down the tree of the block."""
    kind = product_kind(candidates.norm, anchors.norm)
    x = anchors.x.astype(kind)
    mine, theirs = anchors.numbers("label"), candidates.numbers("label")
    parents, apart = anchors.numbers("parent"), anchors.numbers("apart")
    windows = []
    for positives, floors in zip(anchors.lists("positives"), anchors.lists("floors"), strict=True):
        spans = []
        for n, positive in enumerate(positives or []):
            first, last = window(positive, low, high)
            if floors and floors[n] is not None:
                first = max(first, floors[n])
            spans.append((first, last))
        windows.append(spans)
    found = []
    for start in range(0, len(candidates), CHUNK):
        part = slice(start, start + CHUNK)
        y = candidates.x[part].astype(kind)
        norm, row, labels = candidates.norm[part], candidates.row[part], theirs[part]
        ids, nulls = candidates.ids[part], candidates.nulls[part]
        lower, upper = np.empty((len(anchors), len(y))), np.empty((len(anchors), len(y)))
        for i in range(len(anchors)):
            step = apart[i] * (1 + SLACK) * norm + 1e-6
            lo = (lower[parents[i]] if parents[i] >= 0 else 0.0) - step
            hi = (upper[parents[i]] if parents[i] >= 0 else 0.0) + step
            lower[i], upper[i] = lo - SLACK * np.abs(lo), hi + SLACK * np.abs(hi)
            spans = [(a, b) for a, b in windows[i] if a <= b]
            if not spans:
                continue
            overlap = np.zeros(len(y), bool)
            for a, b in joined_spans(spans):
                overlap |= (upper[i] >= a) & (lower[i] <= b)
            at = np.flatnonzero(overlap & (labels != mine[i]))
            if not len(at):
                continue
            scores = y[at] @ x[i]
            lower[i, at] = upper[i, at] = scores.astype(float)
            scores = as_longs(scores)
            for n, (a, b) in enumerate(windows[i]):
                inside = np.flatnonzero((scores >= a) & (scores <= b)) if a <= b else ()
                if len(inside):
                    best = inside[best_first(scores[inside], ids[at[inside]], nulls[at[inside]], count)]
                    k = len(best)
                    found.append((np.full(k, anchors.row[i]), np.full(k, n), ids[at[best]], nulls[at[best]], scores[best]))
    if found:
        anchor, n, ids, nulls, scores = (np.concatenate(c) for c in zip(*found, strict=True))
        yield {"anchor": anchor, "n": n, "vec_id": masked(ids, nulls), "score": scores}


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same numbers in spans that do not overlap."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def mine(
    table: DataFrame,
    every: int,
    label: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; ``label`` is read from ``table``."""
    stages = Stages(table.sparkSession, "negatives")
    whole = whole_vectors(table, SCALE, id_column, vector_column, label).where("label is not null")
    found = usual_length(stages.write(whole, "vectors"))
    rows = stages.write(in_blocks(found, ["label", F.desc("norm"), F.col("row")], BUCKET, "bucket"), "buckets")
    asked = stages.write(near_directions(found.where(F.col("vec_id") % every == 0)), "anchors")
    asked = stages.write(in_blocks(asked, ["label", "code", "row"], BLOCK, "block"), "blocks")
    anchors = stages.write(with_trees(asked), "trees")

    # A pair is taken once however many labels it shares.
    same = rows.select("bucket", "label").distinct().join(anchors.select("block", "label").distinct(), "label")
    same = same.select("bucket", "block").distinct()
    near = meet(rows, anchors, same, "step", "anchor long, vec_id long, score long", lambda c, a: positives_unit(c, a, positives))
    near = best_of(near, ["anchor"], positives)
    near = stages.write(near.select("anchor", (F.col("rank") - 1).alias("n"), "vec_id", "score"), "positives")
    by_rank = F.sort_array(F.collect_list(F.struct("n", "score")))
    scores = near.groupBy(F.col("anchor").alias("row")).agg(by_rank["score"].alias("positives"))
    anchors = stages.write(anchors.join(scores, "row", "left"), "windows")

    buckets, best = rows.agg(F.max("bucket")).first()[0], None
    for first, end in phases(0 if buckets is None else buckets + 1, FIRST):
        if best is None:
            queries = anchors.withColumn("floors", F.lit(None).cast("array<long>"))
        else:
            full = best.groupBy("anchor", "n").agg(F.when(F.count("*") >= negatives, F.min("score")).alias("least"))
            least = near.join(full, ["anchor", "n"], "left").groupBy(F.col("anchor").alias("row"))
            floors = least.agg(F.sort_array(F.collect_list(F.struct("n", "least")))["least"].alias("floors"))
            queries = anchors.join(floors, "row", "left")
        blocks = queries.select("block").distinct()
        pairs = blocks.withColumn("bucket", F.explode(F.sequence(F.lit(first).cast("long"), F.lit(end - 1).cast("long"))))
        work = lambda c, a: negatives_unit(c, a, negatives, low, high)
        more = meet(rows, queries, pairs, "step", "anchor long, n int, vec_id long, score long", work)
        more = more if best is None else more.unionByName(best)
        following = stages.write(best_of(more, ["anchor", "n"], negatives).drop("rank"), "best")
        if best is not None:
            stages.drop(best)
        best = following
    names = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    if best is None:
        best = near.where("false").select("anchor", "n", "vec_id", "score")
    ranked = best_of(best, ["anchor", "n"], negatives)
    ranked = ranked.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
    known = near.withColumnsRenamed({"vec_id": "positive_id", "score": "positive_score"})
    joined = ranked.join(known, ["anchor", "n"]).join(names, "anchor")
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
