import pytest
from pyspark.sql import functions as F

from zonecraft.plans import publication
from zonecraft.schemas import schema
from zonecraft.session import new_stage_path
from zonecraft.sources import publish, tables



def stamp():
    return F.to_timestamp(F.lit("2026-01-02 03:04:05"))


def test_marked_run_is_not_published_again(spark):
    root = new_stage_path(spark, "lake")
    first = publish.with_run(spark.range(3), 2022, stamp())
    publish.publish(first, root, "t")
    publish.publish(first, root, "t")
    assert spark.read.parquet(f"{root}/t").count() == 3
    publish.mark_complete(spark, root, 2022, ["t"], stamp())
    publish.mark_complete(spark, root, 2022, ["t"], stamp())
    publish.publish(publish.with_run(spark.range(9), 2022, stamp()), root, "t")
    assert spark.read.parquet(f"{root}/t").count() == 3
    marker = spark.read.schema(publish.MARKER_SCHEMA).parquet(f"{root}/{publish.MARKERS}").collect()
    assert [(m.succeeded, m.files, m["rows"]) for m in marker] == [(1, ["t"], {"t": 3})]


def test_years_of_one_job_time_are_runs_of_their_own(spark):
    root = new_stage_path(spark, "lake")
    for again in (0, 100):
        for year, size in ((2022, 5), (2026, 7), (None, 2)):
            tables = {"households": spark.range(size + again)}
            publication.publish_run(spark, tables, root, year, "2026-01-02 03:04:05", {"v": "1"}, "b", "me")
    lake = spark.read.parquet(f"{root}/households").groupBy("year").count().collect()
    assert {r.year: r["count"] for r in lake} == {2022: 5, 2026: 7, None: 2}
    markers = spark.read.schema(publish.MARKER_SCHEMA).parquet(f"{root}/{publish.MARKERS}").collect()
    assert {m.year: m["rows"]["households"] for m in markers} == {2022: 5, 2026: 7, None: 2}


def test_year_only_for_numeric_folders(spark):
    assert publish.folder_year("2022") == 2022 and publish.folder_year("2022_sc1") is None
    assert "year" not in publish.with_run(spark.range(1), None, stamp()).columns


def test_metadata_encodes_nested_settings(spark):
    row = publish.run_metadata(spark, 2022, {"v": "1", "years": [1, 2], "sql": {"a": True}}, "b", "me", stamp()).first()
    assert (row.year, row.batch_id, row.years, row.sql) == (2022, "b", "[1, 2]", '{"a": true}')


def test_csv_with_another_schema_fails(spark):
    path = new_stage_path(spark, "csv")
    publish.write_csv(spark.createDataFrame([("007", "x")], "a string, b string"), path)
    assert tables.read_csv(spark, path, schema("a string, b string")).first().a == "007"
    with pytest.raises(Exception):
        tables.read_csv(spark, path, schema("a string, b int")).collect()


def test_forecast_location():
    assert tables.forecast_source("[fc]", "pop") == "`fc`.`pop`"
    assert tables.forecast_source("/data/fc", "pop") == "/data/fc/pop"


def test_own_control_definitions(spark):
    path = new_stage_path(spark, "definitions")
    rows = [("Renters", "mgra", "households", 5, None, None, "VEH = 0 and BLD >= 2")]
    names = "target string, geography string, seed_table string, importance long, control_field string, population string, predicate string"
    publish.write_csv(spark.createDataFrame(rows, names), path)
    (control,) = tables.read_controls(spark, path)
    assert control.field == "Renters"
    df = spark.createDataFrame([(0, 3), (0, 1), (2, 9), (None, 4)], "VEH int, BLD int")
    assert df.agg(F.count_if(control.matches())).first()[0] == 1
