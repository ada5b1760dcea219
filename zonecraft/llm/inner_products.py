"""Exact search for the highest inner products, by buckets of vectors of like length.

Rows are sorted by length and cut into buckets; queries are cut into blocks. A bucket's longest vector and the lowest score
a query's answer must reach give a local threshold of the cosine, score / (query length * bucket length). Above 1 the bucket
holds nothing for the query. Else one of two ways finds candidates in it: by length, the bucket's leading rows that are long
enough for any direction; or by coordinate, the rows whose component along a coordinate in which the query is large lies
within the angle that the threshold allows, checked along ``FOCUS`` such coordinates. The narrowest range is taken where it
holds less than ``COORDINATE_SHARE`` of the leading rows. The products of all candidates are then computed exactly.

Buckets are visited in phases, the longest first; a query's lowest score is its k-th best of the phases before, so it only
rises and no answer is lost. All scores are whole numbers; a row's own id does not keep other rows of that id out.

Rows whose vector is NULL or has NULL or non-finite components take no part, nor vectors of another length than most. Zero
vectors score 0. Rows without an id are candidates but no queries; ties go to the smaller id, none last. Where an id stands
on several rows, each is a query and a candidate of its own. Scores beyond a long are set to its end. An empty table gives no
rows. Only the id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecraft.llm.common import Stages
from zonecraft.llm.int_vectors import Rows, as_longs, best_first, in_blocks, meet, phases, product_kind, whole_vectors
from zonecraft.llm.neighbours import usual_length

SCALE = 1024
BUCKET = 8192
BLOCK = 1024
FIRST = 1  # buckets of the first phase
FOCUS = 4
COORDINATE_SHARE = 0.1
CHUNK = 64  # queries multiplied at once
SLACK = 1e-9  # widens every bound, far above the rounding of doubles


class Bucket:
    """Candidates sorted by falling length, with a sorted list per coordinate made when it is first asked for."""

    def __init__(self, rows: Rows, kind: type):
        order = np.argsort(-rows.norm, kind="stable")
        self.rows, self.x = rows.row[order], rows.x[order].astype(kind)
        self.ids, self.nulls, self.norm = rows.ids[order], rows.nulls[order], rows.norm[order]
        self.unit = rows.x[order] / np.where(self.norm > 0, self.norm, 1)[:, None]
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def leading(self, least: float) -> int:
        """How many rows are at least so long."""
        return int(np.searchsorted(-self.norm, -least * (1 - SLACK), "right"))

    def within(self, coordinate: int, low: float, high: float) -> np.ndarray:
        if coordinate not in self._lists:
            order = np.argsort(self.unit[:, coordinate], kind="stable")
            self._lists[coordinate] = order, self.unit[order, coordinate]
        order, values = self._lists[coordinate]
        return order[np.searchsorted(values, low, "left") : np.searchsorted(values, high, "right")]

    def by_coordinate(self, unit: np.ndarray, cosine: float, most: int) -> np.ndarray | None:
        """Rows that the focus coordinates allow a cosine of at least ``cosine``, or None where they are ``most`` or more."""
        focus = np.argsort(-np.abs(unit))[:FOCUS]
        angle = np.arccos(np.clip(unit[focus], -1, 1))
        reach = np.arccos(cosine)
        low, high = np.cos(np.minimum(angle + reach, np.pi)) - SLACK, np.cos(np.maximum(angle - reach, 0)) + SLACK
        narrow = min((self.within(f, a, b) for f, a, b in zip(focus, low, high, strict=True)), key=len)
        if len(narrow) >= most:
            return None
        seen = self.unit[np.ix_(narrow, focus)]
        return narrow[((seen >= low) & (seen <= high)).all(1)]


def candidates_of(bucket: Bucket, unit: np.ndarray, norm: float, least: float) -> np.ndarray | int:
    """Positions of the candidates, or the number of leading rows that are the candidates."""
    if least <= 0 or norm == 0 or bucket.norm[0] == 0:
        # No length is too short for a score of 0 or less; a product with a zero vector is 0.
        return len(bucket.rows) if least <= 0 else 0
    cosine = least / (norm * bucket.norm[0]) * (1 - SLACK)
    if cosine > 1:
        return 0
    leading = bucket.leading(least / norm)
    found = bucket.by_coordinate(unit, cosine, max(int(COORDINATE_SHARE * leading), 1))
    return leading if found is None else found


def search_unit(candidates: Rows, queries: Rows, k: int) -> Iterator[dict]:
    """The ``k`` best candidates of the bucket that reach a query's lowest score, for every query of the block."""
    kind = product_kind(candidates.norm, queries.norm)
    bucket = Bucket(candidates, kind)
    least = queries.numbers("least").astype(float)  # NaN: any score will do
    least = np.where(np.isnan(least), -np.inf, least)
    units = queries.x / np.where(queries.norm > 0, queries.norm, 1)[:, None]
    x = queries.x.astype(kind)
    chosen = [candidates_of(bucket, units[i], queries.norm[i], least[i]) for i in range(len(queries))]
    found = []

    def keep(i: int, at: np.ndarray, scores: np.ndarray) -> None:
        other = bucket.rows[at] != queries.row[i]
        at, scores = at[other], as_longs(scores[other])
        best = best_first(scores, bucket.ids[at], bucket.nulls[at], k)
        found.append((np.full(len(best), queries.row[i]), bucket.ids[at[best]], bucket.nulls[at[best]], scores[best]))

    by_length = sorted((i for i, c in enumerate(chosen) if isinstance(c, int) and c > 0), key=lambda i: chosen[i])
    for a in range(0, len(by_length), CHUNK):
        some = by_length[a : a + CHUNK]
        most = chosen[some[-1]]
        scores = x[some] @ bucket.x[:most].T
        for n, i in enumerate(some):
            keep(i, np.arange(chosen[i]), scores[n, : chosen[i]])
    for i, at in enumerate(chosen):
        if not isinstance(at, int) and len(at):
            keep(i, at, bucket.x[at] @ x[i])
    if found:
        row, ids, nulls, scores = (np.concatenate(c) for c in zip(*found, strict=True))
        yield {"query": row, "vec_id": masked(ids, nulls), "score": scores}


def masked(ids: np.ndarray, nulls: np.ndarray):
    import pyarrow as pa

    return pa.array(ids, pa.int64(), mask=nulls)


def best_of(found: DataFrame, group: list[str], count: int) -> DataFrame:
    """The ``count`` best rows of a group as ``rank`` 1 and on; Spark drops the others before it shuffles."""
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def top_products(table: DataFrame, k: int, every: int, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` highest products of each row whose id is divisible by ``every``."""
    stages = Stages(table.sparkSession, "products")
    found = usual_length(stages.write(whole_vectors(table, SCALE, id_column, vector_column), "vectors")).drop("label")
    by_length = [F.desc("norm"), F.col("row")]
    rows = stages.write(in_blocks(found, by_length, BUCKET, "bucket"), "buckets")
    asked = found.where(F.col("vec_id") % every == 0)
    asked = stages.write(in_blocks(asked, by_length, BLOCK, "block"), "queries")
    lengths = stages.write(rows.groupBy("bucket").agg(F.max("norm").alias("longest")), "lengths")
    best = None
    for first, end in phases(lengths.count(), FIRST):
        if best is None:
            queries = asked.withColumn("least", F.lit(None).cast("long"))
        else:
            least = best.groupBy(F.col("query").alias("row")).agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
            queries = asked.join(least, "row", "left")
        # A block goes to a bucket where one of its queries may find its lowest score or more.
        share = F.when(F.col("least").isNull() | (F.col("least") <= 0), 0.0).otherwise(F.col("least") / F.col("norm"))
        reach = queries.groupBy("block").agg(F.min(share).alias("needed"))
        spread = reach.withColumn("bucket", F.explode(F.sequence(F.lit(first).cast("long"), F.lit(end - 1).cast("long"))))
        pairs = spread.join(lengths, "bucket").where(F.col("longest") >= F.col("needed") * (1 - SLACK)).select("bucket", "block")
        work = lambda candidates, queries: search_unit(candidates, queries, k)
        more = meet(rows, queries, pairs, "row", "query long, vec_id long, score long", work)
        following = stages.write(best_of(more if best is None else more.unionByName(best), ["query"], k).drop("rank"), "best")
        if best is not None:
            stages.drop(best)
        best = following
    names = asked.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    if best is None:
        return names.where("false").selectExpr("query_id", "0 as rank", "query_id as vec_id", "0L as score")
    return best_of(best, ["query"], k).join(names, "query").select("query_id", "rank", "vec_id", "score")
