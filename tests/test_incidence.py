"""Incidence counted in the seed's roll-up against the incidence of the two seeds."""

import datetime
from collections import Counter

import pytest

from suite import incidence_queries as queries
from zonecraft import definitions as d
from zonecraft.operators import incidence, seed

HOUSEHOLDS = (
    "SERIALNO string, PUMA int, NP int, HINCP double, HHT int, HUPAC int, VEH int, BLD int, TYPEHUGQ int, WGTP int"
)
PERSONS = (
    "SERIALNO string, SPORDER int, AGEP int, SEX int, ESR int, COW int, WKHP int, SCHG int, HISP string, RAC1P string, "
    "MIL int, SCHL int, OCCP int, WKW int, NAICSP string, SOCP string, TYPEHUGQ int, PINCP double, PWGTP int"
)


@pytest.fixture(scope="module")
def survey(spark):
    """Households listed twice, unoccupied, without persons and without a key; persons of no household and without a key."""
    serial = lambda k: None if k is None else f"{2017 + k % 5}{k:09}"
    home = lambda k, kind=1, np=2, puma=1: (serial(k), puma, np, 1000.0 * (k or 1) ** 3, 1, 1, 1, 1, kind, 3)
    households = [*map(home, range(40)), home(3, puma=2), home(3, np=0), home(5, 3), home(6, 2), home(7, np=0), home(None), home(None), home(99)]
    person = lambda k, n: (
        serial(k), n, (n * 17 + (k or 0) * 7) % 95, 1 + n % 2, None if n == 3 else 1 + n % 6, 1, 1, None if n == 1 else 15, ["01", "02", None][n % 3],
        str(n % 10), 1, 1, 1, 1, ["9281", "722511", "62", None, "311"][(n + (k or 0)) % 5], "11", 1 + (k or 0) % 3, 10.0 * n, None if n == 2 else n + 1,
    )
    persons = [person(k, n) for k in [*range(40), None, 77] for n in range(1, 2 + (k or 0) % 5)]
    persons += [person(3, 1), person(3, 4)]
    return spark.createDataFrame(households, HOUSEHOLDS).repartition(3), spark.createDataFrame(persons, PERSONS).repartition(3)


def counted(frame):
    return Counter(map(tuple, frame.collect()))


@pytest.mark.parametrize("tables", [("households", "persons"), ("households",), ("persons",)])
def test_one_pass_gives_the_incidence_of_the_seeds(survey, tables):
    controls = [c for c in d.fitting_controls() if c.seed_table in tables]
    households, persons = seed.seed_households(*survey), seed.seed_persons(survey[1], survey[0])
    wanted = incidence.incidence(households, persons, controls, "SERIALNO", ("PUMA", "WGTP"))
    found = incidence.survey_incidence(*survey, controls, ("PUMA", "WGTP"))
    assert found.dtypes == wanted.dtypes and counted(found) == counted(wanted)
    twice = found.where("PUMA = 2").first()
    assert "persons" not in tables or twice.Total_Pop == 12  # six persons of a household that is listed twice


def test_persons_are_read_once_beside_the_household_sizes(spark, tmp_path):
    tables = {
        "customer": ([(1, 1)], "c_custkey long, c_nationkey int"),
        "orders": ([(k, 1, 9.0, datetime.datetime(1995, 1, 1)) for k in range(9)], "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp"),
        "lineitem": (
            [(k, k, k, 1 + n, 5.0 * n, 7.0) for k in range(9) for n in range(k % 4)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    rows = queries.incidence_rows(spark, str(tmp_path))
    assert counted(rows) == counted(incidence.incidence(*queries.keyed(spark, str(tmp_path)), queries.FITTING, keep=("PUMA", "WGTP")))
    plan = rows._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet [l_orderkey") == 2 and plan.count("FileScan parquet [o_orderkey") == 1
