import random

import pytest
from pyspark.sql import functions as F

from zonecraft.operators.expand import expand, fill_zones, run_offsets, offset_ids, zone_weights
from zonecraft.operators.running import exact_median, number_rows, running_total


def hot_rows(n=400):
    rng = random.Random(7)
    return [("hot" if i % 3 else f"g{i % 5}", i, rng.randint(0, 9)) for i in range(n)]


@pytest.mark.parametrize("partitions", ["1", "4", "17"])
def test_running_total_matches_brute_force(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = hot_rows()
        df = spark.createDataFrame(rows, "g string, k int, a int").repartition(5)
        got = {(r.g, r.k): r.t for r in running_total(df, ["g"], [F.col("k").desc()], "a", "t").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {(g, k): sum(b for h, j, b in rows if h == g and j > k) for g, k, _ in rows}


def test_numbering_without_group_is_contiguous(spark):
    df = spark.range(500).repartition(7)
    got = {r.id: r.number for r in number_rows(df, [], ["id"]).collect()}
    assert got == {i: i + 1 for i in range(500)}


def test_median_of_even_and_odd_counts(spark):
    rows = [("a", v) for v in (1.0, 5.0, 2.0, 2.0)] + [("b", v) for v in (3.0, 9.0, 4.0)] + [("c", None)]
    got = {r.g: r.m for r in exact_median(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", "m").collect()}
    assert got == {"a": 2.0, "b": 4.0}


@pytest.mark.parametrize("chunk", [1, 4, 10_000])
def test_expand_heavy_row_in_chunks(spark, chunk):
    df = spark.createDataFrame([("x", 0), ("y", 1), ("z", 13)], "k string, w long")
    got = sorted((r.k, r.replica) for r in expand(df, "w", chunk=chunk).collect())
    assert got == [("y", 0)] + [("z", i) for i in range(13)]


def test_fill_zones_meets_slots_and_shares(spark):
    rng = random.Random(3)
    slots = [("p", z, rng.randint(0, 6)) for z in range(30)] + [("q", z, 1) for z in range(5)]
    members = [("p", h, rng.randint(0, 9)) for h in range(17)] + [("q", 100, 3)]
    filled = fill_zones(
        spark.createDataFrame(slots, "pool string, mgra int, n long"),
        spark.createDataFrame(members, "pool string, hhid long, w long"),
        ["pool"],
    ).collect()
    per_zone = {(p, z): n for p, z, n in slots if n}
    got_zone, got_house = {}, {}
    for r in filled:
        got_zone[r.pool, r.mgra] = got_zone.get((r.pool, r.mgra), 0) + 1
        got_house[r.pool, r.hhid] = got_house.get((r.pool, r.hhid), 0) + 1
    assert got_zone == per_zone
    total = {p: sum(n for q, _, n in slots if q == p) for p in "pq"}
    weight = {p: sum(w for q, _, w in members if q == p) for p in "pq"}
    for p, h, w in members:
        assert abs(got_house.get((p, h), 0) - w * total[p] / weight[p]) < 1


def test_zone_weights_count_units(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (2, 5)], "mgra int, hhid int")
    assert {(r.mgra, r.integer_weight) for r in zone_weights(df).collect()} == {(1, 2), (2, 1)}


def test_offsets_with_an_empty_first_run(spark):
    rows = [("household", 1), ("household", 2), ("gq_oth", 1)]
    df = spark.createDataFrame(rows, "synthesis_run string, household_id long")
    got = sorted(r.household_id for r in offset_ids(df, run_offsets(df)).collect())
    assert got == [1, 2, 3]
