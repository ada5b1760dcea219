"""Conditions over data frames against pandas, and control files."""

import numpy as np
import pandas as pd
import pytest

from zonecraft import definitions as d
from zonecraft.conditions import BadCondition, to_sql
from zonecraft.session import new_stage_path
from zonecraft.sources import tables

ROWS = pd.DataFrame(
    {
        "a": [0.0, 1.0, 2.0, 5.0, None, 14999.0, -1.0, 7.0],
        "b": [1.0, 1.0, None, 3.0, None, 0.0, 2.0, -4.0],
        "s": ["x", "it's", None, "92", "y\\z", "x", "", "4M"],
    }
)
CONDITIONS = [
    "t.a == 1",
    "(t.a > 0) & (t.a < np.inf)",
    "(t.a >= 0) & (t.a <= 14999)",
    "((t.a == 1) | (t.a == 2) | (t.b == 3))& (t.b >= 1)",
    "(t.a == 1) | (t.a == 5) & (t.b == 99)",
    "((t.a == 1) | (t.a == 5)) & (t.b == 99)",
    "t.s == 'x'",
    't.s == "it\'s"',
    "(t['s'] != 'x') & (t.a >= -1)",
    "t.a != 1",
    "~(t.a > 1)",
    "~((t.a > 1) | (t.s == 'x'))",
    "t.a.isin([1, 2, 7])",
    "~t.s.isin(['x', '92'])",
    "t.a.between(1, 5)",
    "t.a.isna() | t.b.notna()",
    "(t.a + t.b * 2 > 4) & (-t.b < +2)",
    "(t.a - 1) % 2 == 0",
    "t.a > -np.inf",
    "t.a * 2 >= 1.5",
]


@pytest.mark.parametrize("text", CONDITIONS)
def test_conditions_agree_with_data_frames(spark, text):
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in ROWS.itertuples()]
    df = spark.createDataFrame(rows, "i long, a double, b double, s string")
    frame = ROWS.assign(s=ROWS["s"].astype(object))
    want = set(np.flatnonzero(eval(text, {"t": frame, "np": np}).astype(bool)))  # noqa: S307
    assert {r.i for r in df.where(to_sql(text, "t")).collect()} == want


@pytest.mark.parametrize(
    "text, part",
    [
        ("t.a == 1 & t.b == 2", "need brackets|not a value"),
        ("other.a == 1", "not a column of t"),
        ("t.a", "not a condition"),
        ("t.a ==", "not an expression"),
        ("__import__('os').system('x') == 0", "not a value"),
        ("(t.a == 1) & t.b", "not a condition"),
        ("t.a is None", "data frames do not|not a value"),
        ("t.s.str.contains('x')", "not a condition"),
    ],
)
def test_other_expressions_are_refused(text, part):
    with pytest.raises(BadCondition, match=part):
        to_sql(text, "t")


def written(spark, lines):
    path = new_stage_path(spark, "definitions")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


HEAD = "target,geography,seed_table,importance,control_field,expression"


def test_a_file_of_controls(spark):
    lines = [HEAD, "Large,mgra,households,250000,HHSize_4Plus,(households.NP >= 4) & (households.WGTP < np.inf)", 'Kids,region,persons,,,"persons.AGEP.isin([0, 1])"']
    large, kids = tables.read_controls(spark, written(spark, lines))
    assert (large.target, large.field, large.importance, large.geography) == ("Large", "HHSize_4Plus", 250000, "mgra")
    assert (kids.field, kids.importance, kids.seed_table, kids.population) == ("Kids", None, "persons", None)
    df = spark.createDataFrame([(4, 1.0), (5, None), (3, 2.0)], "NP int, WGTP double")
    assert df.where(large.matches()).count() == 1


@pytest.mark.parametrize(
    "line, part",
    [
        ("A,mgra,households,1,,households.NP = 1", "line 2, target A"),
        ("A,county,households,1,,households.NP == 1", "none of mgra"),
        ("A,mgra,homes,1,,homes.NP == 1", "none of households"),
        ("A,mgra,households,-5,,households.NP == 1", "importance"),
        ("A,mgra,households,1,,", "line 2: no expression"),
        (",mgra,households,1,,households.NP == 1", "line 2: no target"),
    ],
)
def test_bad_files_name_the_line(spark, line, part):
    with pytest.raises(ValueError, match=part):
        tables.read_controls(spark, written(spark, [HEAD, line]))


def test_a_target_stands_once():
    with pytest.raises(ValueError, match="twice"):
        d.checked_controls([d.Control("A", "mgra", "households", 1, "true")] * 2)
