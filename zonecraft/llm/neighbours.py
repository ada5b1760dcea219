"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

Equal vectors are one node (its id is their smallest ``vec_id``), so a vector that stands on any number of rows costs no
more than one. A first graph comes from ``TREES`` random orders: vectors are sorted by the signs of their products with
random directions and compared within blocks of ``BLOCK`` rows. Then each node's neighbours and the nodes that have it as
a neighbour meet; those of a pair of which at least one edge is new are compared, and each keeps the nearest it meets if they
beat its present ones. This is repeated ``ROUNDS`` times, and on until less than ``SETTLED`` of all edges are new. A node that very many others point to has them meet in several blocks
along with its own neighbours, so no list is cut off. Each node keeps its ``DEGREE`` nearest.

Search: a query starts from its own node and moves along edges in both directions. The ``POOL`` nearest nodes met are
kept, times the doublings of the table's size, and in each step those of them not yet left are expanded. The walk ends when
of the nodes kept for all queries less than ``ARRIVED`` remain to be left: nothing nearer lies beside the others. Distances that decide the answer are
computed in double precision from the vectors as given.

Rows whose vector is NULL, empty, zero or has NULL or non-finite components take no part, nor rows without an id. Where
an id stands on several rows, the smallest vector (by its bytes) counts. Vectors of another length than most have no
distance to the others and take no part. Ties go to the smaller id. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecraft.llm.common import Stages, map_batches

DEGREE = 24
BLOCK = 1024
TREES = 16
FIRST = 12  # nearest that a node keeps from one block
ROUNDS = 3  # at least, so that small tables, whose first graph is nearly right, are treated like large ones
SETTLED = 0.03
KEPT = 8  # nearest that a node keeps from one meeting
MEETING = 32  # nodes that point to one node and meet in one block, about
POOL = 16
ARRIVED = 0.02
TASK = 100_000  # rows with vectors that a task compares, about
SEED = 32_452_843
EDGES = "node long, neighbour long, d float"


def valid_vectors(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, v``: one row per id; v holds the components as little-endian doubles."""
    plain = table.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            lists = batch.column(1)
            sizes = np.nan_to_num(np.array(lists.value_lengths().to_numpy(zero_copy_only=False), float)).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<f8")
            ends = np.cumsum(sizes)
            ids, kept = [], []
            for vec_id, a, b in zip(batch.column(0).to_pylist(), ends - sizes, ends, strict=True):
                own = flat[a:b]
                if vec_id is not None and np.isfinite(own).all() and own.any():
                    ids.append(vec_id)
                    kept.append((own + 0.0).tobytes())  # -0.0 is 0.0
            yield {"vec_id": ids, "v": kept}

    found = map_batches(plain, "vec_id long, v binary", work)
    return found.groupBy("vec_id").agg(F.min("v").alias("v"))


def usual_length(vectors: DataFrame) -> DataFrame:
    usual = vectors.groupBy(F.length("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").limit(1)
    row = usual.first()
    return vectors.where(F.length("v") == (row.n if row else 0))


def as_matrix(column: pa.Array, kind: str = "<f4") -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def in_single(nodes: DataFrame) -> DataFrame:
    """The nodes with components in single precision, half the bytes: enough to choose candidates."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            if batch.num_rows:
                yield {"node": batch.column(0), "v": [r.tobytes() for r in as_matrix(batch.column(1), "<f8").astype("<f4")]}

    return map_batches(nodes, "node long, v binary", work)


def directions(tree: int, count: int, size: int) -> np.ndarray:
    return np.random.default_rng([SEED, tree]).standard_normal((size, count)).astype(np.float32)


def nearest(matrix: np.ndarray, count: int, allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Per row the ``count`` nearest other rows and their squared distances (infinite where not allowed)."""
    squares = (matrix * matrix).sum(1)
    d = np.maximum(squares[:, None] + squares[None, :] - 2 * (matrix @ matrix.T), 0)
    np.fill_diagonal(d, np.inf)
    if allowed is not None:
        d[~allowed] = np.inf
    count = min(count, len(matrix) - 1)
    at = np.argpartition(d, count - 1, axis=1)[:, :count] if 0 < count < len(matrix) - 1 else np.argsort(d, axis=1)[:, :count]
    return at, np.take_along_axis(d, at, 1)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of rows sorted by ``keys``: a table and where its groups begin, and its end. Groups may span batches."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table]).combine_chunks()
        starts = _starts(table, keys)
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), starts
        held = table.slice(starts[-1]) if len(starts) else table
    if held is not None and held.num_rows:
        yield held, np.append(_starts(held, keys), held.num_rows)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    changes = np.zeros(table.num_rows, bool)
    changes[:1] = True
    for key in keys:
        values = table.column(key).to_numpy()
        changes[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(changes)


def first_graph(nodes: DataFrame, count: int) -> DataFrame:
    """Edges among the rows of the same block in ``TREES`` random orders."""
    bits = min(max(int(math.log2(max(count / BLOCK, 1))), 0), 60)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            matrix = as_matrix(batch.column(1))
            for tree in range(TREES):
                products = matrix @ directions(tree, bits + 1, matrix.shape[1])
                code = ((products[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64))) if bits else np.zeros(len(matrix), np.int64)
                yield {"tree": np.full(len(matrix), tree), "code": code, "along": products[:, bits], "node": batch.column(0), "v": batch.column(1)}

    def block(rows: pa.Table) -> Iterator[dict]:
        ids = rows.column("node").to_numpy()
        at, d = nearest(as_matrix(rows.column("v").combine_chunks()), FIRST)
        if at.size:
            yield {"node": np.repeat(ids, at.shape[1]), "neighbour": ids[at].ravel(), "d": d.ravel()}

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: pa.Table | None = None
        for batch in batches:
            held = pa.concat_tables([held, pa.Table.from_batches([batch])]) if held else pa.Table.from_batches([batch])
            edges = np.append(_starts(held, ["tree"]), held.num_rows)
            done = 0
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                last = b == held.num_rows  # more rows of this tree may follow: two blocks wait for them
                end = max(b - 2 * BLOCK, a) if last else b
                cuts = np.linspace(a, end, max((end - a) // BLOCK, 1) + 1).astype(np.int64)
                for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                    yield from block(held.slice(x, y - x)) if y > x else ()
                done = end
            held = held.slice(done)
        if held is not None and held.num_rows:
            edges = np.append(_starts(held, ["tree"]), held.num_rows)
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                yield from block(held.slice(a, b - a))

    placed = map_batches(nodes, "tree int, code long, along float, node long, v binary", place)
    ordered = placed.repartitionByRange("tree", "code", "along").sortWithinPartitions("tree", "code", "along", "node")
    return map_batches(ordered, EDGES, compare)


def keep_nearest(edges: DataFrame, count: int) -> DataFrame:
    """The ``count`` nearest neighbours of each node; an edge that was there before is not new."""
    # Dealt by node alone, which serves the window too.
    known = edges.repartition("node").groupBy("node", "neighbour").agg(F.min("d").alias("d"), F.min("new").alias("new"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy("d", "neighbour"))
    return known.withColumn("_rank", rank).where(F.col("_rank") <= count).drop("_rank")


def meetings(graph: DataFrame, nodes: DataFrame, count: int) -> DataFrame:
    """Better edges found where the neighbours of a node meet; ``count`` is the number of nodes."""
    radius = graph.groupBy("node").agg(F.when(F.count("*") >= DEGREE, F.max("d")).alias("radius"))
    members = nodes.join(radius, "node", "left").withColumnRenamed("node", "member")
    incoming = graph.groupBy("neighbour").agg(F.ceil(F.count("*") / MEETING).cast("int").alias("parts"))
    own = graph.select(F.col("node").alias("host"), F.col("neighbour").alias("member"), "new")
    own = own.join(incoming.withColumnRenamed("neighbour", "host"), "host", "left")
    own = own.select("host", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"), "member", "new")
    back = graph.select(F.col("neighbour").alias("host"), F.col("node").alias("member"), "new")
    back = back.join(incoming.withColumnRenamed("neighbour", "host"), "host")
    back = back.select("host", F.pmod(F.xxhash64("member"), "parts").cast("int").alias("part"), "member", "new")
    present = own.unionByName(back).join(members, "member").repartition("host", "part").sortWithinPartitions("host", "part")
    # Of a small table no more tasks than it is worth; a meeting stays in one.
    present = present.coalesce(max(8, 2 * DEGREE * count // TASK))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for table, starts in runs(batches, ["host", "part"]):
            matrix = as_matrix(table.column("v").combine_chunks())
            ids = table.column("member").to_numpy()
            new = table.column("new").to_numpy() > 0
            radius = np.nan_to_num(table.column("radius").to_numpy().astype(np.float32), nan=np.inf)
            found = []
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                # A meeting without a new edge has nothing to tell; a member may come by an edge in either direction.
                if not new[a:b].any():
                    continue
                order = a + np.lexsort((~new[a:b], ids[a:b]))
                at = order[np.append(True, ids[order[1:]] != ids[order[:-1]])]
                if len(at) < 2:
                    continue
                near, d = nearest(matrix[at], KEPT, new[at, None] | new[None, at])
                better = d < radius[at, None]
                found.append((ids[at][np.nonzero(better)[0]], ids[at][near[better]], d[better]))
            if found:
                yield {n: np.concatenate(c) for n, c in zip(("node", "neighbour", "d"), zip(*found, strict=True), strict=True)}

    return map_batches(present.select("host", "part", "member", "new", "radius", "v"), EDGES, work)


def build_graph(nodes: DataFrame, stages: Stages) -> DataFrame:
    """``node, neighbour, d`` (squared), the ``DEGREE`` nearest found for each node."""
    count = nodes.count()
    graph = stages.write(keep_nearest(first_graph(nodes, count).withColumn("new", F.lit(1)), DEGREE), "graph")
    share, rounds = 1.0, 0
    while share >= SETTLED or rounds < ROUNDS:
        found = meetings(graph, nodes, count).withColumn("new", F.lit(1))
        known = graph.withColumn("new", F.lit(0))
        following = stages.write(keep_nearest(known.unionByName(found), DEGREE), "graph")
        stages.drop(graph)
        graph = following
        # An edge replaces a farther one, so rounds come to an end.
        share, rounds = graph.agg(F.avg("new")).first()[0] or 0.0, rounds + 1
    return graph.drop("new")


def distances(pairs: DataFrame, nodes: DataFrame, kind: str, tasks: int) -> DataFrame:
    """``query, node, d``: Euclidean distance, summed in double precision, for pairs of nodes, in at most so many tasks."""
    left = nodes.select(F.col("node").alias("query"), F.col("v").alias("_left"))
    both = pairs.select("query", "node").join(nodes, "node").join(left, "query").select("query", "node", "_left", "v").coalesce(tasks)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            if batch.num_rows:
                apart = as_matrix(batch.column(2), kind).astype(float) - as_matrix(batch.column(3), kind)
                yield {"query": batch.column(0), "node": batch.column(1), "d": np.sqrt((apart * apart).sum(1))}

    return map_batches(both, "query long, node long, d double", work)


def search(queries: DataFrame, graph: DataFrame, nodes: DataFrame, stages: Stages) -> DataFrame:
    """``query, node, d``: the nearest nodes that a greedy walk from each query's own node meets."""
    backward = graph.select(F.col("neighbour").alias("node"), F.col("node").alias("neighbour"))
    ways = stages.write(graph.select("node", "neighbour").unionByName(backward).distinct(), "ways")
    order = Window.partitionBy("query").orderBy("d", "node")
    held = POOL * max(nodes.count().bit_length(), 1)

    def trimmed(met: DataFrame) -> DataFrame:
        kept = met.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= held).drop("_rank")
        return stages.write(kept.coalesce(parts), "pool")

    start = queries.select(F.col("node").alias("query"), "node").distinct()
    # Pools and what a step meets are small beside the tables: a few tasks serve them.
    parts = max(8, queries.count() * held // TASK)
    pool = trimmed(start.select("query", "node", F.lit(0.0).alias("d"), F.lit(False).alias("left")))
    remaining = lambda: pool.agg(F.avg((~F.col("left")).cast("int"))).first()[0] or 0.0
    while remaining() >= ARRIVED:
        reached = pool.where("not left").select("query", "node").join(ways, "node").select("query", F.col("neighbour").alias("node"))
        fresh = reached.distinct().join(pool.select("query", "node"), ["query", "node"], "left_anti")
        met = distances(fresh, nodes, "<f4", 4 * parts).withColumn("left", F.lit(False))
        before = pool.select("query", "node", "d", F.lit(True).alias("left"))
        following = trimmed(before.unionByName(met))
        stages.drop(pool)
        pool = following
    return pool.select("query", "node", "d")


def nearest_neighbours(table: DataFrame, k: int, every: int, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """For each row whose id is divisible by ``every``: ``query_id, rank, vec_id, score`` of its ``k`` nearest rows."""
    stages = Stages(table.sparkSession, "neighbours")
    vectors = usual_length(stages.write(valid_vectors(table, id_column, vector_column), "vectors"))
    nodes = stages.write(vectors.groupBy("v").agg(F.min("vec_id").alias("node")).select("node", "v"), "nodes")
    # Of equal vectors no more than k + 1 can be among the answers to one query.
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    first = vectors.withColumn("_rank", rank).where(F.col("_rank") <= k + 1).drop("_rank")
    members = stages.write(first.join(nodes, "v").select("node", "vec_id"), "members")
    asked = vectors.where(F.col("vec_id") % every == 0).join(nodes, "v").select("node", F.col("vec_id").alias("query_id"))
    asked = stages.write(asked, "queries")

    slim = stages.write(in_single(nodes), "single")
    graph = build_graph(slim, stages)
    # Some more than k + 1 nodes, each of which holds at least one row, decide the answer in double precision.
    near = F.row_number().over(Window.partitionBy("query").orderBy("d", "node"))
    pool = search(asked, graph, slim, stages).withColumn("_rank", near).where(F.col("_rank") <= 2 * k + 10)
    near_nodes = distances(pool, nodes, "<f8", max(8, asked.count() * (2 * k + 10) // TASK))
    near_rows = near_nodes.join(members, "node").select("query", "vec_id", "d")
    answers = asked.withColumnRenamed("node", "query").join(near_rows, "query").where("vec_id <> query_id")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("d", "vec_id"))
    ranked = answers.withColumn("rank", place).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", F.col("d").alias("score"))
