"""Markers from what the writes have seen, pick-up by keyed state, pruned reads, physical types and profiles."""

import random

import pytest
from pyspark.sql import functions as F

from zonecraft.operators import quality, seed
from zonecraft.plans import publication
from zonecraft.session import new_stage_path
from zonecraft.sources import physical, publish, runs
from zonecraft.streaming.ingest import ingest_completed

STAMPS = ["2026-01-02 03:04:05", "2026-01-03 03:04:05", "2026-01-04 03:04:05"]
ROWS = "id long, run_timestamp timestamp, year int"


def stamp(text=STAMPS[0]):
    return F.to_timestamp(F.lit(text))


def markers_of(spark, root):
    return spark.read.schema(publish.MARKER_SCHEMA).parquet(f"{root}/{publish.MARKERS}")


def test_markers_name_the_rows_that_the_writes_have_seen(spark, monkeypatch):
    monkeypatch.setattr(publish, "count_published", lambda *a: pytest.fail("tables are read again"))
    root = new_stage_path(spark, "lake")
    tables = {"a": spark.range(37).repartition(5), "b": spark.range(0)}
    for _ in range(2):  # publishing a finished run again keeps what its marker says
        names = publication.publish_run(spark, tables, root, 2022, STAMPS[0], {"v": "1"}, "b", "me")
        assert names == ["a", "b", "run_metadata"]
        (marker,) = markers_of(spark, root).collect()
        assert marker["rows"] == {"a": 37, "b": 0, "run_metadata": 1} and marker.succeeded == 3
    publication.publish_run(spark, {"a": spark.range(5)}, root, 2026, STAMPS[0], {"v": "1"}, "b", "me")
    assert {m.year: m["rows"]["a"] for m in markers_of(spark, root).collect()} == {2022: 37, 2026: 5}


def test_a_failed_attempt_is_counted_anew(spark):
    root = new_stage_path(spark, "lake")
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        publication.publish_run(spark, {"a": spark.range(9), "z": broken}, root, 2022, STAMPS[0], {}, "b", "me")
    publication.publish_run(spark, {"a": spark.range(4), "z": spark.range(2)}, root, 2022, STAMPS[0], {}, "b", "me")
    (marker,) = markers_of(spark, root).collect()
    assert marker["rows"]["a"] == 4 == spark.read.parquet(f"{root}/a").count()


def test_a_load_that_is_repeated_does_not_double(spark):
    path = new_stage_path(spark, "append")
    for size, run in ((3, 1), (5, 2), (4, 1)):
        publish.append_run(spark.range(size), path, run)
    assert {r.run_id: r["count"] for r in spark.read.parquet(path).groupBy("run_id").count().collect()} == {1: 4, 2: 5}


# --- pick-up -----------------------------------------------------------------------------------------------------


class Lake:
    def __init__(self, spark):
        self.spark = spark
        self.root, self.target, self.progress = [new_stage_path(spark, n) for n in ("lake", "target", "progress")]

    def write(self, year, text, first, size):
        rows = self.spark.range(first, first + size).withColumns({"run_timestamp": stamp(text), "year": F.lit(year).cast("int")})
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*publish.RUN).parquet(f"{self.root}/t")

    def mark(self, year, text, names):
        publish.mark_complete(self.spark, self.root, year, dict.fromkeys(names, 1), stamp(text))

    def pick_up(self):
        ingest_completed(self.spark, self.root, "t", ROWS, self.target, self.progress)
        found = self.spark.read.schema(ROWS).parquet(self.target).groupBy("year", "run_timestamp")
        seen = found.agg(F.count("*").alias("n"), F.min("id").alias("low")).collect()
        return {(r.year, str(r.run_timestamp)): (r.n, r.low) for r in seen}


def test_each_run_is_admitted_once_across_restarts(spark):
    lake = Lake(spark)
    for year, text, first in ((2022, STAMPS[1], 0), (None, STAMPS[1], 100), (2022, STAMPS[0], 200)):
        lake.write(year, text, first, 10)
    lake.mark(2022, STAMPS[1], ["t"])
    lake.mark(None, STAMPS[1], ["t", "u"])
    assert lake.pick_up() == {(2022, STAMPS[1]): (10, 0), (None, STAMPS[1]): (10, 100)}
    # A marker written again, for a run whose rows have changed since, admits nothing; the earlier run comes late.
    lake.write(2022, STAMPS[1], 500, 3)
    lake.mark(2022, STAMPS[1], ["t"])
    lake.mark(2022, STAMPS[0], ["t"])
    assert lake.pick_up() == {(2022, STAMPS[1]): (10, 0), (None, STAMPS[1]): (10, 100), (2022, STAMPS[0]): (10, 200)}
    before = lake.pick_up()
    assert lake.pick_up() == before


def test_a_marker_must_name_the_table(spark):
    lake = Lake(spark)
    lake.write(2022, STAMPS[0], 0, 10)
    lake.write(2023, STAMPS[0], 50, 2)
    lake.mark(2022, STAMPS[0], ["other"])
    lake.mark(2023, STAMPS[0], ["t"])
    assert lake.pick_up() == {(2023, STAMPS[0]): (2, 50)}
    lake.mark(2022, STAMPS[0], ["other", "t"])
    assert lake.pick_up() == {(2023, STAMPS[0]): (2, 50), (2022, STAMPS[0]): (10, 0)}


def test_the_target_is_not_read(spark):
    """The state is the stream's own: rows taken out of the target do not come back."""
    lake = Lake(spark)
    lake.write(2022, STAMPS[0], 0, 10)
    lake.mark(2022, STAMPS[0], ["t"])
    lake.pick_up()
    empty = spark.createDataFrame([], ROWS)
    lake.target = new_stage_path(spark, "moved")
    empty.write.parquet(lake.target)
    lake.mark(2022, STAMPS[0], ["t"])
    assert lake.pick_up() == {}


# --- pruned reads ------------------------------------------------------------------------------------------------


def test_folders_of_other_runs_are_not_opened(spark):
    lake = Lake(spark)
    for k, year in enumerate((2022, 2023, 2024, None)):
        lake.write(year, STAMPS[0], 10 * k, 5)
    lake.mark(2023, STAMPS[0], ["t"])
    lake.mark(None, STAMPS[0], ["t"])
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{lake.root}/t")
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    broken = 0
    for status in store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{lake.root}/t/year=202[24]/*/*.parquet")):
        out = store.create(status.getPath(), True)
        out.write(bytearray(b"not a table"))
        out.close()
        broken += 1
    assert broken >= 2
    data = spark.read.schema(ROWS).parquet(f"{lake.root}/t")
    done = runs.read_completed(data, markers_of(spark, lake.root))
    assert sorted(r.id for r in done.collect()) == [*range(10, 15), *range(30, 35)]
    assert "dynamicpruning" in done._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception):
        data.agg(F.sum("id")).collect()


# --- physical types ----------------------------------------------------------------------------------------------


def test_runs_of_other_types_are_named(spark):
    root = new_stage_path(spark, "lake")
    plain = spark.range(20).select("id", F.col("id").cast("string").alias("code"), F.lit(1.5).alias("x"))
    variants = {2020: plain, 2021: plain, 2023: plain.drop("x"), 2024: plain.withColumn("new", F.lit(1))}
    variants[2022] = plain.withColumn("code", F.col("code").cast("int"))
    for year, rows in variants.items():
        publish.publish(publish.with_run(rows, year, stamp()), root, "t")
    schemas = physical.published_schemas(spark, root, "t")
    found = {(r.year, r.column, r.kind, r.usual) for r in quality.schema_drift(schemas).collect()}
    assert found == {(2022, "code", "int32", "string"), (2023, "x", None, "double")}
    assert {str(r.run_timestamp) for r in schemas.select("run_timestamp").distinct().collect()} == {STAMPS[0]}
    plan = schemas._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan  # files are listed, their bytes are not


def test_files_of_one_run_that_disagree(spark):
    rows = [(2022, STAMPS[0], "f1", "a", "int32"), (2022, STAMPS[0], "f2", "a", "string"), (2023, STAMPS[0], "f3", "a", "string")]
    schemas = spark.createDataFrame(rows, "year int, run_timestamp string, file string, column string, kind string")
    (found,) = quality.schema_drift(schemas).collect()
    assert (found.year, found.kind, found.usual, found.files) == (2022, "int32", "string", 1)
    assert quality.schema_drift(schemas.where("false")).count() == 0


# --- profiles ----------------------------------------------------------------------------------------------------


def test_profiles_merge_within_their_error(spark):
    rng = random.Random(3)
    rows = [(k % 3, rng.randrange(9000), f"s{rng.randrange(40)}", None if k % 5 else k) for k in range(30_000)]
    df = spark.createDataFrame(rows, "run int, a long, b string, c long")
    exact = {r.column: r for r in seed.distinct_profile(df, ["a", "b", "c"]).collect()}
    assert exact["b"].distinct == 40 and exact["c"].nulls == 24_000 and exact["a"].rows == 30_000
    parts = [seed.sketch_profile(df.where(F.col("run") == run), ["a", "b", "c"]) for run in range(3)]
    stored = parts[0].unionByName(parts[1]).unionByName(parts[2])
    merged = {r.column: r for r in seed.merged_profile(stored).collect()}
    for column, r in merged.items():
        assert (r.rows, r.nulls) == (exact[column].rows, exact[column].nulls)
        assert abs(r.distinct - exact[column].distinct) <= 0.03 * exact[column].distinct
    by_run = {(r.run, r.column): r.distinct for r in seed.distinct_profile(df, ["b"], ["run"]).collect()}
    assert by_run == {(k, "b"): 40 for k in range(3)}
