import pytest
from pyspark.sql import functions as F

from zonecraft.functions import seed as fn
from zonecraft.operators import seed as ops


def values(df):
    return [r[0] for r in df.collect()]


def test_gq_type_first_match_wins(spark):
    rows = [(1, None, None, 0), (2, None, None, 3), (3, 1, None, 1), (3, 4, 15, 2), (3, 1, 15, 1), (3, None, None, 3), (2, 1, None, 3), (9, 1, 15, None)]
    df = spark.createDataFrame(rows, "h int, m int, s int, want int")
    got = df.select(fn.gq_type(F.col("h"), F.col("m"), F.col("s")).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_race_null_origin_falls_through(spark):
    rows = [(None, "1", "White alone"), ("02", "2", "Hispanic"), ("01", "0", None), ("01", "7", "Other"), (None, None, None)]
    df = spark.createDataFrame(rows, "h string, r string, want string")
    got = df.select(fn.race(F.col("h"), F.col("r")).alias("got"), fn.race_from_numbers(F.col("h"), F.col("r")).alias("num"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got] == [r.num for r in got]


def test_industry_sector(spark):
    rows = [("92811", "MIL"), ("722511", "722"), ("7211", "721"), ("92", "92"), ("4M", "4M"), (None, None)]
    df = spark.createDataFrame(rows, "n string, want string")
    got = df.select(fn.industry_sector(F.col("n")).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_income_is_adjusted_by_survey_year(spark):
    df = spark.createDataFrame([("2017000000001", 1000.0), ("2021000000001", None)], "s string, i double")
    assert values(df.select(fn.adjust_income(F.col("i"), F.col("s")))) == [round(1000 * 344.416 / 283.012), None]


def test_unknown_survey_year_fails(spark):
    df = spark.createDataFrame([("1999000000001", 1.0)], "s string, i double")
    with pytest.raises(Exception, match="No price index"):
        df.select(fn.adjust_income(F.col("i"), F.col("s"))).collect()


def test_flags_treat_null_as_no(spark):
    df = spark.createDataFrame([(None,), (1,), (3,), (6,)], "e int")
    assert [tuple(r) for r in df.select(fn.in_labor_force(F.col("e")), fn.is_worker(F.col("e"))).collect()] == [(0, 0), (1, 1), (1, 0), (0, 0)]


def test_hhid_is_dense_per_kind_and_shared_by_persons(spark):
    households = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2), ("d", 3), ("e", 9)], "SERIALNO string, TYPEHUGQ int")
    persons = spark.createDataFrame([("a", 1), ("a", 1), ("d", 3), ("e", 9)], "SERIALNO string, TYPEHUGQ int")
    h, p = ops.assign_hhid(households, persons)
    assert {(r.SERIALNO, r.hhid) for r in h.collect()} == {("a", 1), ("b", 2), ("c", 1), ("d", 2)}
    assert sorted((r.SERIALNO, r.hhid) for r in p.collect()) == [("a", 1), ("a", 1), ("d", 2)]


def test_empty_run_is_reported(spark):
    df = spark.createDataFrame([(0,), (1,), (1,), (None,)], "gq_type int")
    got = {r.synthesis_run: (r.n, r.is_empty) for r in ops.empty_runs(ops.split_runs(df)).collect()}
    assert got == {"household": (1, False), "gq_mil": (2, False), "gq_col": (0, True), "gq_oth": (0, True)}


def test_seed_persons_of_the_chain_are_those_of_the_single_steps(spark):
    """Households and persons that come twice, persons of another type than their household, NULL keys."""
    from suite.standins import standin
    from zonecraft.operators import seed
    from zonecraft.plans import synthesis

    households, persons = (standin(spark, "/root/testdata/sf0.001", n) for n in ("household_src", "person_src"))
    households = households.unionByName(households.where("household_id % 5 = 0"))
    persons = persons.unionByName(persons.where("household_id % 7 = 0"))
    other = F.expr("cast(if(household_id % 11 = 0 and SPORDER = 1, 3, TYPEHUGQ) as int)")
    persons = persons.withColumns({"TYPEHUGQ": other, "SERIALNO": F.expr("if(household_id % 13 = 0, null, SERIALNO)")})
    old, members = seed.assign_hhid(seed.seed_households(households, persons), seed.seed_persons(persons, households))
    old = seed.split_runs(old)
    members = members.join(old.select("is_gq", "hhid", "synthesis_run"), ["is_gq", "hhid"])
    found = synthesis.build_seeds(households, persons)
    for was, now in ((old, found.households), (members, found.persons)):
        assert set(was.columns) == set(now.columns) and was.count() > 1000
        assert was.exceptAll(now.select(was.columns)).count() == now.select(was.columns).exceptAll(was).count() == 0
    files = [f.rsplit("_", 1)[1].split(".")[0] for f in found.persons.inputFiles()]
    assert len(files) == len(set(files)) == 4  # one file a bucket


def test_scratch_tables_go_but_those_kept(spark):
    from pathlib import Path

    from zonecraft.session import CLEANUP, scratch, stage

    there = lambda table: Path(table.stage_path.removeprefix("file:")).exists()
    before = spark.conf.get(CLEANUP, None)
    with scratch() as keep:
        first = stage(spark.range(3))
        with scratch() as keep_inner:
            inner, second = stage(spark.range(4)), keep_inner(stage(spark.range(5)))
        assert not there(inner) and there(second)
        kept = keep(stage(first.join(second, "id")))
    assert there(kept) and kept.count() == 3 and not there(first) and not there(second)
    assert spark.conf.get(CLEANUP, None) == before
