"""Whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

With A the table of rows less their mean, a run starts from a unit vector v1 and alternates two distributed products:
``u = A v - beta u_before`` and ``v_next = A' u - alpha v``, both within one reading of the rows. Each new vector is made
orthogonal to all before it on its side. The small bidiagonal matrix of the alphas and betas has singular values and vectors
that approach those of A from both ends; a run stops when the wanted ones have settled or the space is exhausted, and goes
through the whole space where that has at most ``WHOLE`` dimensions.

Only vectors as long as a row are on the driver. A left vector is as long as the table and is never stored: it is A w for a
w that is carried along, so a pass makes the left vectors of its block of rows anew. A run from one vector finds one
direction of each repeated deviation, so found directions are locked and runs from vectors at right angles to them follow,
until one finds nothing above what is wanted. Components are unit vectors; their sign makes the largest entry positive.

Rows whose vector is NULL or has NULL or non-finite entries take no part, nor vectors of another length than most. Rows
without an id, of one id and equal rows each count and are returned. Directions without deviation have no component, so
fewer than ``count`` may come back, none for tables without any deviation. ``deviation`` is NULL where it exceeds a long.
An empty table gives no rows. Only the id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecraft.llm.common import Stages, map_batches
from zonecraft.llm.int_vectors import matrix, whole_vectors
from zonecraft.llm.neighbours import usual_length

SCALE = 1024
OFFSET = 100_000
SETTLED = 1e-14  # of the largest deviation: the miss at which a direction has settled
CANCELLED = 1e-2  # share of a left vector left by the others, below which it is made orthogonal a second time
WHOLE = 128  # dimensions up to which a run goes through the whole space
CHECKED = 1e-6  # the same for the largest direction of a run that only looks for something missed
LEAST = 1e-8  # of the largest deviation: below this a direction has none
SEED = 86_028_121


class Table:
    """The rows as a written table; every pass returns sums over all rows, which are as long as the work makes them."""

    def __init__(self, rows: DataFrame, offset: int):
        self.rows, self.offset = rows, offset
        self.size = 0

    def sums(self, work: Callable[[np.ndarray], np.ndarray], kind: str = "<f8") -> np.ndarray:
        offset, size = self.offset, self.size

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            total = None
            for batch in batches:
                if batch.num_rows:
                    part = work(matrix(batch.column(0), size) + offset)
                    total = part if total is None else total + part
            if total is not None:
                yield {"total": [np.ascontiguousarray(total, kind).tobytes()]}

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            parts = [np.frombuffer(t, kind) for batch in batches for t in batch.column(0).to_pylist()]
            if parts:
                yield {"total": [np.sum(parts, 0).astype(kind).tobytes()]}

        # One short row per partition meets in the last task.
        partial = map_batches(self.rows.select("v"), "total binary", blocks)
        # Collected, not the first row taken: a Python worker whose rows are not all read cannot be used again.
        return np.frombuffer(map_batches(partial.repartition(1), "total binary", whole).collect()[0].total, kind)


@dataclass
class Found:
    """Directions as columns, falling deviations (singular values of the centred table), and whether all are known."""

    directions: np.ndarray
    values: np.ndarray
    settled: int
    exhausted: bool
    steps: int


def orthogonal(vector: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        vector = vector - basis @ (basis.T @ vector)
    return vector


def bidiagonalise(table: Table, centre: np.ndarray, scale: float, locked: Found | None, wanted: int, accuracy: float, seed: int) -> Found:
    """One run in the space at right angles to the locked directions."""
    size = len(centre)
    fixed = np.empty((size, 0)) if locked is None else locked.directions
    left_fixed = fixed if locked is None else fixed / locked.values
    back_fixed = fixed if locked is None else fixed * locked.values
    room = size - fixed.shape[1]
    tiny = scale * LEAST
    v = orthogonal(np.random.default_rng([SEED, seed]).standard_normal(size), fixed)
    right, left, behind = [v / np.linalg.norm(v)], [], []  # the v, the w with u = A w, and A' u
    alphas, betas = [], []
    while True:
        before, back = np.column_stack([left_fixed, *left]), np.column_stack([back_fixed, *behind])

        def products(w: np.ndarray, before: np.ndarray = before) -> tuple[np.ndarray, np.ndarray, float]:
            """X w = u, then X' u, and what of u lies along the left vectors so far."""

            def block(x: np.ndarray) -> np.ndarray:
                rows = x - centre
                u = rows @ w
                return np.concatenate([rows.T @ u, (rows @ before).T @ u, [u @ u]])

            sums = table.sums(block)
            return sums[:size], sums[size:-1], float(sums[-1])

        # What is taken away from u is taken away from X' u by what is known of the left vectors.
        w = right[-1] - (betas[-1] * left[-1] if betas else 0)
        product, along, square = products(w)
        w, product, rest = w - before @ along, product - back @ along, square - along @ along
        if rest < CANCELLED * square:
            # Most of u is gone, and with it the digits: once more from the vector that is left.
            product, along, square = products(w)
            w, product, rest = w - before @ along, product - back @ along, square - along @ along
        alpha = float(np.sqrt(max(rest, 0.0)))
        if alpha <= tiny:
            return _settle(right, [*alphas, 0.0], betas, 0.0, True, accuracy, scale)
        left.append(w / alpha)
        behind.append(product / alpha)
        alphas.append(alpha)
        v = orthogonal(behind[-1] - alpha * right[-1], np.column_stack([fixed, *right]))
        beta = float(np.linalg.norm(v))
        ended = beta <= tiny or len(right) == room
        found = _settle(right, alphas, betas, 0.0 if ended else beta, ended, accuracy, scale)
        if ended or found.settled >= wanted:
            return found
        betas.append(beta)
        right.append(v / beta)


def _settle(right: list, alphas: list, betas: list, rest: float, exhausted: bool, accuracy: float, scale: float) -> Found:
    """Singular values and right vectors of the bidiagonal matrix; a direction's miss is the rest times its last left entry."""
    small = np.diag(alphas)
    small[np.arange(len(betas)), np.arange(1, len(betas) + 1)] = betas
    p, values, q = np.linalg.svd(small)
    settled = np.abs(rest * p[-1]) <= accuracy * scale
    count = len(values) if exhausted else int(np.argmin(np.append(settled, False)))
    return Found(np.column_stack(right) @ q.T, values, count, exhausted, len(right))


def components(table: Table, centre: np.ndarray, count: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` directions of largest deviation as columns, with the singular values; fewer where there are no more."""
    size, known, seed = len(centre), None, 0
    while True:
        have = 0 if known is None else len(known.values)
        if have >= size:
            break
        first = known is None or have < count
        wanted = size if size <= WHOLE else count - have
        run = bidiagonalise(table, centre, scale, known, wanted if first else 1, SETTLED if first else CHECKED, seed)
        seed += 1
        least = 0 if first else known.values[count - 1]
        new = run.values[: run.settled]
        if new[0] <= max(least * (1 + CHECKED), scale * LEAST):
            break
        if not first:  # something was missed: find it well before it is locked
            run = bidiagonalise(table, centre, scale, known, 1, SETTLED, seed)
            new = run.values[: run.settled]
        directions = run.directions[:, : len(new)]
        if known is not None:
            directions, new = np.column_stack([known.directions, directions]), np.concatenate([known.values, new])
        order = np.argsort(-new, kind="stable")
        keep = order[new[order] > scale * LEAST]
        known = Found(directions[:, keep], new[keep], len(keep), False, run.steps)
        if run.exhausted and run.steps + have >= size:
            break
    if known is None:
        return np.empty((size, 0)), np.empty(0)
    found = known.directions[:, :count]
    largest = np.abs(found).argmax(0)
    return found * np.sign(found[largest, np.arange(found.shape[1])]), known.values[:count]


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(table: DataFrame, count: int = 8, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """One row per remaining row and component, as the docstring of the module says."""
    stages = Stages(table.sparkSession, "whitening")
    rows = usual_length(stages.write(whole_vectors(table, SCALE, id_column, vector_column), "vectors")).select("vec_id", "v")
    one = rows.select("v").first()
    empty = table.sparkSession.createDataFrame([], SCHEMA)
    if one is None or not len(one.v):
        return empty
    rows_of = Table(rows, OFFSET)
    rows_of.size = size = len(one.v) // 8

    # Exact sums: each number in two halves, whose sums stay within a long for 2**31 rows and more.
    def halves(x: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x)], (x >> 31).sum(0), (x & (2**31 - 1)).sum(0)])

    sums = [int(s) for s in rows_of.sums(halves, "<i8")]
    n = sums[0]
    totals = [(high << 31) + low for high, low in zip(sums[1 : size + 1], sums[size + 1 :], strict=True)]
    centre = np.array([t / n for t in totals])
    trace = float(rows_of.sums(lambda x: np.array([((x - centre) ** 2).sum()]))[0])
    if trace <= 0:
        return empty
    directions, values = components(rows_of, centre, count, np.sqrt(trace))
    deviations = values / np.sqrt(n)
    to_white = directions / deviations

    def products(x: np.ndarray) -> np.ndarray:
        white = (x - centre) @ to_white
        return np.concatenate([white.sum(0), (white.T @ white).ravel()])

    seen = rows_of.sums(products) / n
    k = len(values)
    means, square = seen[:k], seen[k:].reshape(k, k)
    error = float(np.abs(square - np.outer(means, means) - np.eye(k)).max())
    explained = values**2 / trace

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1), size) + OFFSET
            white = (x - centre) @ to_white
            yield {
                "vec_id": batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))),
                "component": np.tile(np.arange(1, k + 1), len(x)),
                "n": np.full(len(x) * k, n),
                "deviation": pa.array([d for d in exact_deviations(x, n, totals) for _ in range(k)], pa.int64()),
                "whitened": white.ravel(),
                "explained": np.tile(explained, len(x)),
                "identity_error": np.full(len(x) * k, error),
            }

    return map_batches(rows, SCHEMA, work)


def exact_deviations(x: np.ndarray, n: int, totals: list[int]) -> list[int | None]:
    """Per row the sum over dimensions of (n x - S)**2; None where no long holds it."""
    largest = max(int(np.abs(x).max()) * n, max(abs(t) for t in totals)) * 2
    if largest**2 * x.shape[1] < 2**63:
        apart = x * n - np.array(totals, np.int64)
        return [int(d) for d in (apart * apart).sum(1)]
    apart = x.astype(object) * n - np.array(totals, object)
    found = (apart * apart).sum(1)
    return [int(d) if d < 2**63 else None for d in found]
