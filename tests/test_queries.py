"""Registered queries against DuckDB on the smallest tables, and the plans of the important ones."""

import re

import pytest

import suite.catalog  # noqa: F401
from suite import check
from suite.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
QUICK = [
    "j03_zone_control_join",
    "j01_seed_households",
    "j02_seed_persons",
    "w01_assign_hhid",
    "u03_stack_comparisons",
    "p33_report_columns",
    "a10_run_report",
    "a11_summarize_controls",
    "y08_integerize",
    "y09_fill_zones",
    "y13_gq_synthesis",
    "j13_replica_persons",
    "t01_ingest_completed",
]


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF)


@pytest.mark.parametrize("name", QUICK)
def test_same_rows_as_sql(spark, duck, name):
    verdict, _ = check.compare(spark, duck, name, SF)
    assert verdict == "ok"  # also the same types


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_year_filter_and_columns_reach_the_scan(spark):
    text = plan(spark, "s03_read_microdata")
    assert "ReadSchema: struct<SERIALNO:string,SPORDER:int,AGEP:int,SEX:" in text and "PINCP" not in text
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(increment,2022\)", plan(spark, "s01_read_forecast"))
    assert re.search(r"PushedFilters: \[[^\]]*In\(increment", plan(spark, "s02_read_forecast_years"))


@pytest.mark.parametrize("name", ["j03_zone_control_join", "y11_zone_summary", "y01_incidence", "j01_seed_households"])
def test_no_single_partition_and_no_cartesian_product(spark, name):
    text = plan(spark, name)
    assert "SinglePartition" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_aggregates_combine_before_the_shuffle(spark):
    assert plan(spark, "a01_conditional_sum").count("HashAggregate") == 2
