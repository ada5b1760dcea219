import pytest
from pyspark.sql import functions as F

from zonecraft import definitions as d
from zonecraft.functions import report as fn
from zonecraft.operators import expand, incidence, keys, quality, reporting, reshape


def test_control_set_is_complete():
    controls = d.fitting_controls()
    assert len(controls) == 55
    assert sum(c.geography == "mgra" for c in controls) == 37
    assert sum(c.seed_table == "households" for c in controls) == 16
    assert len(d.MGRABASE_COLUMNS) == 62


def test_diff_pct(spark):
    rows = [(None, 1, None), (0, 0, 0.0), (0, 5, None), (4, 5, 25.0), (4, 4, 0.0), (1, 250, 24900.0), (3, None, None)]
    df = spark.createDataFrame(rows, "c int, r int, want double")
    got = df.select(fn.diff_pct(F.col("c"), F.col("r")).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_categories(spark):
    df = spark.createDataFrame([("GQ_Military",), ("Total_Pop",), (None,), ("x",), ("HHWork_0",)], "f string")
    got = df.select(fn.category_local(F.col("f")), fn.category_sql(F.col("f"))).collect()
    assert [tuple(r) for r in got] == [
        ("Group Quarters", "Group Quarters"),
        ("Household Population", None),
        ("Uncategorized", None),
        (None, None),
        ("Household Workers", "Household Workers"),
    ]


def test_text_cleaning(spark):
    df = spark.createDataFrame([("",), ("3.0",), ("10.05",), (".0",), (None,)], "t string")
    assert [r[0] for r in df.select(fn.clean_numeric_text(F.col("t"))).collect()] == [None, "3", "10.05", "", None]
    names = spark.createDataFrame([("mgra15_based_input_2035",), ("synthetic_persons_2035",)], "n string")
    assert [r[0] for r in names.select(fn.lake_name(F.col("n"))).collect()] == ["mgra15_based_input", "synthetic_persons_2035"]
    runs = spark.createDataFrame([("2022_sc1",), ("base",)], "n string")
    assert [r[0] for r in runs.select(fn.display_year(F.col("n"))).collect()] == ["2022", "base"]


def test_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (-2.5e-3,)], "v double")
    assert [r[0] for r in df.select(fn.half_even(F.col("v"))).collect()] == [0.12, 0.38, -0.0]


def test_merge_defaults_keep_null_income(spark):
    rows = [(7, None, None, 1, 2), (7, -1.0, 3, None, None), (7, 0.0, 3, 1, 1), (7, 10.0, 3, 1, 1)]
    df = spark.createDataFrame(rows, "PUMA int, HHADJINC double, HHT int, HUPAC int, BLD int")
    got = [tuple(r) for r in expand.merged_households(df).collect()]
    assert got == [(None, 0, 1, 2), (0.0, 3, 0, 0), (0.0, 3, 1, 1), (10.0, 3, 1, 1)]


def test_all_null_group_sums_to_null(spark):
    rows = [(1, "t", "f", "mgra", 5, None, None, "s"), (2, "t", "f", "mgra", 5, None, 3, "s"), (2, "t", "f", "mgra", 6, 4, 1, "s")]
    df = spark.createDataFrame(rows, "control_id long, target string, control_field string, geography string, id long, control_value long, result long, Status string")
    none = spark.createDataFrame([], "target string")
    got = {r.control_id: (r.control_value, r.result) for r in reporting.region_totals(df, none).collect()}
    assert got == {1: (None, None), 2: (4, 4)}


def test_alignment(spark):
    controls = spark.createDataFrame([("t", "mgra", 1, 5), ("t", "mgra", 2, 6)], "target string, geography string, id long, control_value long")
    results = spark.createDataFrame([("t", "mgra", 2, 7), ("t", "mgra", 3, 8)], "target string, geography string, id long, result long")
    got = {r.id: (r.control_value, r.result) for r in reporting.align_benchmarks(controls, results).collect()}
    assert got == {1: (5, 0), 2: (6, 7), 3: (None, 8)}
    assert {r.result for r in reporting.align_benchmarks(controls, None).collect()} == {None}


def test_duplicate_and_missing_crosswalk_fail(spark):
    rows = spark.createDataFrame([(1,), (2,)], "id long")
    twice = spark.createDataFrame([(1, 7), (1, 8), (2, 7)], "mgra long, PUMA int")
    with pytest.raises(Exception, match="more than once"):
        incidence.with_puma(rows, twice).collect()
    part = spark.createDataFrame([(1, 7)], "mgra long, PUMA int")
    with pytest.raises(Exception, match="no PUMA"):
        incidence.with_puma(rows, part).collect()


def test_missing_classification_fails(spark):
    df = spark.createDataFrame([(1, None)], "household_id long, gq_type int")
    with pytest.raises(Exception, match="no gq_type"):
        reporting.household_population(df).collect()


def test_first_per_key_breaks_ties_by_order(spark):
    rows = [("a", 1, 5, "x"), ("a", 0, 9, "y"), ("a", 0, 8, "z")]
    df = spark.createDataFrame(rows, "t string, p int, o int, v string")
    assert [r.v for r in keys.first_per_key(df, ["t"], ["p", "o"]).collect()] == ["z"]


def test_only_the_suffix_is_taken_off(spark):
    df = spark.createDataFrame([("PUMA", 1, 2, 3)], "geography string, id int, a_control_x_control int, a_control_x_result int")
    row = reshape.melt_summary(df).first()
    assert (row.geography, row.target, row.control_value, row.result) == ("puma", "a_control_x", 2.0, 3.0)


def test_summary_statistics(spark):
    rows = [(1, "Sex", "Male", 1, 10.0), (1, "Sex", "Male", -4, -20.0), (2, "Sex", "Female", 3, None), (3, None, "odd", 5, 1.0)]
    df = spark.createDataFrame(rows, "id int, Category string, `Control Field` string, Diff int, `Diff %` double")
    got = {(r.block, r["Control Field"]): r for r in reporting.summarize_controls(df).collect()}
    assert set(got) == {(0, "Male"), (0, "Female"), (0, "odd"), (1, "Sex")}
    male = got[0, "Male"]
    assert (male["Avg Diff"], male["Med Diff"], male["Max |Diff|"], male["Max |Diff %|"]) == (-1.5, -1.5, 4.0, 20.0)
    assert got[1, "Sex"]["Med Diff"] == 1.0 and got[0, "Female"]["Med Diff %"] is None


def test_null_and_infinite_weight_match_nothing(spark):
    total = next(c for c in d.fitting_controls() if c.target == "Total_HH")
    df = spark.createDataFrame([(1.0,), (0.0,), (None,), (float("inf"),), (float("nan"),)], "WGTP double")
    assert df.agg(F.count_if(total.matches())).first()[0] == 1


def test_enforce_stops_on_violations(spark):
    df = spark.createDataFrame([(1, 2)], "workers int, NP int")
    quality.enforce("workers", quality.impossible_workers(df))
    with pytest.raises(ValueError, match="workers"):
        quality.enforce("workers", quality.impossible_workers(df.withColumn("NP", F.lit(0))))
