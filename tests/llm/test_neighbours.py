"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from zonecraft.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, v string, node long"


def brute(rows, k=10, every=100):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, d)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def found(spark, rows, **options):
    table = spark.createDataFrame([(i, None if v is None else list(v), "x", 1) for i, v in rows], SCHEMA).repartition(3)
    out = {}
    for r in neighbours.nearest_neighbours(table, options.get("k", 10), options.get("every", 100)).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [v for v, _ in got[q]] == [v for v, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-6)


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(300)]
    same(found(spark, rows), brute(rows))


def test_copies_ties_and_invalid_vectors(spark):
    rng = np.random.default_rng(2)
    hot = [1.0, 0.0, 2.0]
    rows = [(i, hot if i % 3 else rng.standard_normal(3).astype(np.float32).tolist()) for i in range(0, 400)]
    bad = [(1000, None), (1100, []), (1200, [0.0, 0.0, 0.0]), (1300, [float("nan"), 1.0, 1.0]), (1400, [1.0, None, 1.0])]
    bad += [(1500, [float("inf"), 0.0, 1.0]), (1600, [1.0, 2.0]), (None, [1.0, 2.0, 3.0]), (0, rows[0][1])]
    same(found(spark, rows + bad), brute(rows))


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (7, [0.0, 1.0])]
    same(found(spark, rows), brute(rows))
    assert found(spark, [(100, [1.0, 2.0])]) == {} and found(spark, []) == {}


def test_recall_where_blocks_do_not_hold_the_table(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 100)
    monkeypatch.setattr(neighbours, "TREES", 6)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 16))
    rows = [(i, (centres[i % 12] + 0.7 * rng.standard_normal(16)).astype(np.float32).tolist()) for i in range(3000)]
    want, got = brute(rows), found(spark, rows)
    hits = [len({v for v, _ in want[q]} & {v for v, _ in got[q]}) / 10 for q in want]
    assert got.keys() == want.keys() and np.mean(hits) >= 0.9


def test_a_hub_meets_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "MEETING", 4)
    rng = np.random.default_rng(4)
    rows = [(0, [0.01] * 6)] + [(i, (v / np.linalg.norm(v)).astype(np.float32).tolist()) for i, v in enumerate(rng.standard_normal((400, 6)), 1)]
    same(found(spark, rows), brute(rows))
