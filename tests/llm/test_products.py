"""Exact products, whitening and hard negatives against brute force, over awkward rows."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from zonecraft.llm import hard_negatives, inner_products, int_vectors, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, row string, v string, norm string, block string, bucket string, n string"


def table(spark, rows):
    rows = [(i, None if x is None else [None if c is None else float(c) for c in x], label, *["x"] * 6) for i, x, label in rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def usable(rows):
    """Rows that take part, with single-precision vectors; the usual length is that of the first row."""
    kept = [(i, np.array(x, np.float32).astype(float), label) for i, x, label in rows if x and None not in x]
    return [r for r in kept if np.isfinite(r[1]).all() and len(r[1]) == len(rows[0][1])]


def whole(x, scale):
    return [int(c) for c in np.floor(np.array(x) * scale)]


def ranked(scored):
    """Ids in order of falling score, ties to smaller ids, none last."""
    return sorted(scored, key=lambda s: (-s[1], s[0] is None, s[0] or 0))


def best(rows, k, every, scale=1024):
    kept = [(i, whole(x, scale)) for i, x, _ in usable(rows)]
    out = []
    for a, (i, x) in enumerate(kept):
        if i is not None and i % every == 0:
            product = lambda y: min(max(sum(p * q for p, q in zip(x, y, strict=True)), -(2**63)), 2**63 - 1)
            scored = [(j, product(y)) for b, (j, y) in enumerate(kept) if b != a]
            out += [(i, r, j, s) for r, (j, s) in enumerate(ranked(scored)[:k], 1)]
    return out


def order(rows):
    return sorted(rows, key=str)


def clouds(seed, count, size, spread, centres=6):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((centres, size))
    lengths = rng.uniform(0.2, 3, count)
    return [(i, (lengths[i] * (middle[i % centres] + spread * rng.standard_normal(size))).tolist(), i % centres) for i in range(count)]


def awkward(seed=1):
    rows = clouds(seed, 260, 5, 0.4)
    hot = rows[7][1]
    rows += [(300 + i, hot, i % 3) for i in range(120)]
    rows += [(1000, None, 1), (1010, [], 1), (1020, [0.0] * 5, 2), (1030, [float("nan")] * 5, 1), (1040, [1.0, None, 1.0, 1.0, 1.0], 1)]
    rows += [(1050, [float("inf"), 0.0, 1.0, 0.0, 0.0], 0), (1060, [1.0, 2.0], 0), (None, hot, 1), (None, [0.5] * 5, 2), (-20, [0.3] * 5, 4)]
    rows += [(40, hot, 2), (40, hot, 2), (50, [9.0, 1.0, 0.0, 0.0, 0.0], None), (70, [0.1] * 5, 9)]
    return rows


def found(spark, rows, k=4, every=10):
    got = inner_products.top_products(table(spark, rows), k, every)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return order(tuple(r) for r in got.collect())


@pytest.mark.parametrize("size", [8192, 16])
def test_products_of_awkward_rows(spark, monkeypatch, size):
    """In one bucket, and in many that are visited in phases."""
    monkeypatch.setattr(inner_products, "BUCKET", size)
    monkeypatch.setattr(inner_products, "BLOCK", size)
    rows = awkward()
    assert found(spark, rows) == order(best(rows, 4, 10))


def test_both_ways_are_taken_and_agree(spark, monkeypatch):
    """Tight clouds of unlike lengths: some queries are pruned along coordinates, some by length."""
    rows = clouds(3, 900, 8, 0.02, 30)
    # Two clouds in three are of one length, so their rows have to be told apart by direction.
    rows = [(i, (np.array(v) / np.linalg.norm(v) * (3 if i % 3 else 3 * i / 900)).tolist(), m) for i, v, m in rows]
    kept = [(i, np.array(whole(x, 1024))) for i, x, _ in usable(rows)]
    x = np.array([v for _, v in kept])
    norm = np.sqrt((x * x).sum(1, dtype=float))
    side = type("Side", (), {"row": np.arange(900), "norm": norm, "ids": np.arange(900), "nulls": np.zeros(900, bool), "x": x})
    bucket = inner_products.Bucket(side, np.float64)
    ways = set()
    for q in range(0, 900, 7):
        scores = x @ x[q]
        least = np.sort(scores)[-12]
        chosen = inner_products.candidates_of(bucket, x[q] / max(norm[q], 1), norm[q], float(least))
        ways.add(type(chosen))
        rows_of = bucket.rows[:chosen] if isinstance(chosen, int) else bucket.rows[chosen]
        assert set(np.flatnonzero(scores >= least)) <= set(rows_of.tolist())
    assert len(ways) == 2
    monkeypatch.setattr(inner_products, "BUCKET", 100)
    assert found(spark, rows, 10, 50) == order(best(rows, 10, 50))


def test_products_beyond_doubles(spark):
    rows = [(i, [float(10**e) * s, 3.0 * i, 1.0], 0) for i, (e, s) in enumerate([(7, 1), (7, -1), (6, 1), (0, 1), (12, 1), (5, 1), (7, 1)])]
    assert found(spark, rows, 3, 2) == order(best(rows, 3, 2))


def test_empty_and_single_rows(spark):
    assert found(spark, []) == [] and found(spark, [(0, [1.0, 2.0], 1)]) == []
    assert whitening.whiten(table(spark, [])).count() == 0 and whitening.whiten(table(spark, [(0, [1.0, 2.0], 1)])).count() == 0
    assert negatives(spark, []) == [] and negatives(spark, [(0, [1.0, 2.0], 1)]) == []


def test_blocks_do_not_depend_on_partitions(spark):
    rows = spark.range(100).selectExpr("id as row", "cast(id % 3 as double) as norm", "cast('x' as binary) as v")
    got = int_vectors.in_blocks(rows, [F.desc("norm"), F.col("row")], 16, "block").groupBy("block").count().collect()
    assert sorted(r["count"] for r in got) == [4, 16, 16, 16, 16, 16, 16]
    assert list(int_vectors.phases(20, 1)) == [(0, 1), (1, 8), (8, 20)] and list(int_vectors.phases(0, 1)) == []


# --- whitening ---------------------------------------------------------------------------------------------------


def check_whitening(spark, rows, count=8):
    kept = usable(rows)
    x = np.array([whole(v, 1024) for _, v, _ in kept], np.int64) + 100_000
    n, total = len(x), x.sum(0)
    centred = x - total / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(count, int((values > 1e-14 * values[0]).sum()))
    got = whitening.whiten(table(spark, rows), count).collect()
    assert len(got) == n * k and {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-9
    for r in got:
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
    deviations = ((n * x - total) ** 2).sum(1)
    assert sorted((str(r.vec_id), r.deviation) for r in got if r.component == 1) == sorted(
        (str(i), int(d)) for (i, _, _), d in zip(kept, deviations, strict=True)
    )
    return got, kept, centred, values, vectors


def test_whitening_of_awkward_rows(spark):
    rows = awkward(4)
    got, kept, centred, values, vectors = check_whitening(spark, rows)
    want = centred @ vectors[:, :5] / np.sqrt(values[:5])
    for c in range(5):
        mine = sorted((str(r.vec_id), r.whitened) for r in got if r.component == c + 1)
        plain = [sorted((str(i), s * w) for (i, _, _), w in zip(kept, want[:, c], strict=True)) for s in (1, -1)]
        miss = [max(abs(a - b) for (_, a), (_, b) in zip(mine, p, strict=True)) for p in plain]
        assert min(miss) < 1e-9


@pytest.mark.parametrize("whole_space", [128, 0])
def test_repeated_and_missing_deviations(spark, monkeypatch, whole_space):
    """Equal deviations in several directions and constant columns, also where runs stop as soon as they have settled."""
    monkeypatch.setattr(whitening, "WHOLE", whole_space)
    corners = [(i, [float(j == i % 12) for j in range(12)] + [2.0, 2.0], 0) for i in range(48)]
    got, *_ = check_whitening(spark, corners)
    assert {r.component for r in got} == set(range(1, 9))
    two = [(i, [1.0 * (i % 2), 3.0 * (i % 3), 0.0], 0) for i in range(30)]
    check_whitening(spark, two)


def test_runs_that_stop_early(spark, monkeypatch):
    monkeypatch.setattr(whitening, "WHOLE", 0)
    rng = np.random.default_rng(5)
    scales = 2.0 ** -np.arange(24)
    rows = [(i, (50 * scales[:20] * v).tolist(), 0) for i, v in enumerate(rng.standard_normal((300, 20)))]
    steps, run = [], whitening.bidiagonalise
    monkeypatch.setattr(whitening, "bidiagonalise", lambda *a: steps.append(run(*a)) or steps[-1])
    check_whitening(spark, rows, 3)
    assert steps[0].steps < 20 and not steps[0].exhausted


def test_deviations_beyond_a_long():
    x = np.array([[2**40, 0], [0, 5], [1, 1]])
    assert whitening.exact_deviations(x, 3, [2**40 + 1, 6])[0] is None
    small = np.array([[4, 0], [0, 5], [1, 1]])
    assert whitening.exact_deviations(small, 3, [5, 6]) == [49 + 36, 25 + 81, 4 + 9]


# --- hard negatives ----------------------------------------------------------------------------------------------


def wanted_negatives(rows, every, scale=256):
    kept = [(i, whole(x, scale), label) for i, x, label in usable([r for r in rows if r[2] is not None])]
    out = []
    for a, (i, x, label) in enumerate(kept):
        if i is None or i % every:
            continue
        scored = [(j, sum(p * q for p, q in zip(x, y, strict=True)), m) for b, (j, y, m) in enumerate(kept) if b != a]
        same = ranked([s for s in scored if s[2] == label])[:5]
        other = ranked([s for s in scored if s[2] != label])
        for j, s, _ in same:
            inside = [o for o in other if 30 * s <= 100 * o[1] <= 90 * s][:10]
            out += [(i, j, r, o, s, t) for r, (o, t, _) in enumerate(inside, 1)]
    return out


def negatives(spark, rows, every=10):
    found = hard_negatives.mine(table(spark, rows), every, F.col("label"))
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return order(tuple(r) for r in found.collect())


@pytest.mark.parametrize("size", [8192, 24])
def test_negatives_of_awkward_rows(spark, monkeypatch, size):
    monkeypatch.setattr(hard_negatives, "BUCKET", size)
    monkeypatch.setattr(hard_negatives, "BLOCK", min(size, 512))
    rows = awkward(6)
    want = wanted_negatives(rows, 10)
    assert len(want) > 500 and negatives(spark, rows) == order(want)


def test_bounds_spare_products(spark, monkeypatch):
    """Near anchors: far fewer products than pairs, in one unit as over the whole table."""
    rows = clouds(8, 600, 16, 0.02, 12)
    kept = usable(rows)
    x = np.array([whole(v, 256) for _, v, _ in kept], np.int64)
    order_, parent, length = hard_negatives.spanning_tree(x[:200].astype(float))
    assert sorted(order_.tolist()) == list(range(200)) and parent[0] == -1 and all(0 <= p < i for i, p in enumerate(parent) if i)
    apart = np.sqrt(((x[:200, None] - x[None, :200]) ** 2).sum(2))
    assert length[1:] == pytest.approx([apart[order_[i], order_[parent[i]]] for i in range(1, 200)])
    monkeypatch.setattr(hard_negatives, "BUCKET", 64)
    assert negatives(spark, rows, 7) == order(wanted_negatives(rows, 7))


def test_windows_hold_exactly_the_scores_in_them():
    for positive in range(-40, 300):
        first, last = hard_negatives.window(positive, 30, 90)
        assert [s for s in range(-60, 300) if 30 * positive <= 100 * s <= 90 * positive] == list(range(first, last + 1))
    assert hard_negatives.joined_spans([(5, 9), (1, 3), (4, 6), (20, 30)]) == [(1, 9), (20, 30)]
