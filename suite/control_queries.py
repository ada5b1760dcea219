"""Forecast scans and control totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.registry import query
from suite.standins import ctes, standin
from zonecraft.definitions import (
    AGE_BANDS,
    AGE_GROUP_IDS,
    ECONOMIC_LABELS,
    ETHNICITY_IDS,
    INCOME_BANDS,
    INCOME_SOURCES,
    MGRABASE_COLUMNS,
)
from zonecraft.operators import controls, seed
from zonecraft.session import new_stage_path
from zonecraft.sources import tables

YEARS = list(range(2022, 2029))


def _sum(condition: str, name: str) -> str:
    return f"cast(sum(case when {condition} then hhp else 0 end) as bigint) as {name}"


ASE = f"""ase as (select mgra, increment, cast(sum(hhp) as bigint) as Total_Pop,
  {_sum('sex_id = 2', 'Male')}, {_sum('sex_id = 1', 'Female')},
  {', '.join(_sum(f'age_group_id between {a} and {b}', n) for (n, _, _), (a, b) in zip(AGE_BANDS, AGE_GROUP_IDS))},
  {', '.join(_sum(f'ethnicity_id in ({", ".join(map(str, i))})', n) for n, i in ETHNICITY_IDS.items())}
  from pop_ase_mgra group by mgra, increment)"""
HHC = """hhc as (select mgra, increment, cast(sum(hhs1) as bigint) as HHSize_1, cast(sum(hhs2) as bigint) as HHSize_2,
  cast(sum(hhs3) as bigint) as HHSize_3, cast(sum(hhs4 + hhs5 + hhs6 + hhs7) as bigint) as HHSize_4Plus,
  cast(sum(hhs1 + hhs2 + hhs3 + hhs4 + hhs5 + hhs6 + hhs7) as bigint) as Total_HH,
  cast(sum(hhworkers0) as bigint) as HHWork_0, cast(sum(hhworkers1) as bigint) as HHWork_1,
  cast(sum(hhworkers2) as bigint) as HHWork_2, cast(sum(hhworkers3) as bigint) as HHWork_3Plus,
  cast(sum(hhwoc) as bigint) as HHChild_0, cast(sum(hhwc) as bigint) as HHChild_1Plus
  from hh_characteristics_mgra group by mgra, increment)"""
INC = f"""inc as (select mgra, increment,
  {', '.join(f'{" + ".join(f"i{k}" for k in s)} as {n}' for (n, _, _), s in zip(INCOME_BANDS, INCOME_SOURCES))},
  gq_civ_college as gq_college_pop, gq_mil as gq_mil_pop, gq_civ_other as gq_other_pop from mgrabase)"""
ZONES = f"""{ASE}, {HHC}, {INC}, zones as (select *, Total_HH + gq_college_pop + gq_mil_pop + gq_other_pop as Total_HH_GQ
  from ase join hhc using (mgra, increment) join inc using (mgra, increment))"""
FORECAST = ("pop_ase_mgra", "hh_characteristics_mgra", "mgrabase")


def zones(spark, sf, year=None):
    keep = (lambda d: tables.for_year(d, year)) if year else (lambda d: tables.for_years(d, YEARS))
    return controls.zone_controls(*[keep(standin(spark, sf, name)) for name in FORECAST])


def written(spark, sf, name):
    """A folder that holds the stand-in as a table, as the readers find it."""
    folder = new_stage_path(spark, "forecast")
    standin(spark, sf, name).write.parquet(f"{folder}/{name}")
    return folder


def ase_rows(spark, sf):
    return controls.population_controls(standin(spark, sf, "pop_ase_mgra"))


@query("s01_read_forecast", f"{ctes('pop_ase_mgra')} select * from pop_ase_mgra where increment = 2022")
def _(spark, sf):
    return tables.read_forecast(spark, "pop_ase_mgra", written(spark, sf, "pop_ase_mgra"), 2022)


@query(
    "s02_read_forecast_years",
    f"{ctes('hh_characteristics_mgra')} select * from hh_characteristics_mgra where increment in (2022, 2024, 2026)",
)
def _(spark, sf):
    folder = written(spark, sf, "hh_characteristics_mgra")
    return tables.read_forecast_years(spark, "hh_characteristics_mgra", folder, [2022, 2024, 2026])


@query("a01_conditional_sum", f"{ctes('pop_ase_mgra')}, {ASE} select * from ase")
def _(spark, sf):
    return controls.population_controls(standin(spark, sf, "pop_ase_mgra"))


@query("a02_household_sums", f"{ctes('hh_characteristics_mgra')}, {HHC} select * from hhc")
def _(spark, sf):
    return controls.household_controls(standin(spark, sf, "hh_characteristics_mgra"))


@query("p17_income_bands", f"{ctes('mgrabase')}, {INC} select * from inc")
def _(spark, sf):
    return controls.income_and_gq_controls(standin(spark, sf, "mgrabase"))


@query(
    "p16_land_use_projection",
    f"""{ctes('mgrabase_wide')} select increment,
    {', '.join('emp_tot as emp_total' if c == 'emp_total' else c for c in MGRABASE_COLUMNS)} from mgrabase_wide""",
)
def _(spark, sf):
    return controls.land_use_output(standin(spark, sf, "mgrabase_wide"))


@query(
    "p18_total_hh_gq",
    f"""{ctes(*FORECAST)}, {ZONES} select mgra, increment, Total_HH_GQ from zones""",
)
def _(spark, sf):
    return zones(spark, sf).select("mgra", "increment", "Total_HH_GQ")


@query("j03_zone_control_join", f"{ctes(*FORECAST)}, {ZONES} select * from zones where increment = 2022")
def _(spark, sf):
    return zones(spark, sf, 2022)


@query("o01_zones_sorted", f"{ctes(*FORECAST)}, {ZONES} select * from zones order by increment, mgra")
def _(spark, sf):
    return seed.sorted_output(zones(spark, sf), "increment", "mgra")


@query(
    "u06_zones_in_every_input",
    f"""{ctes(*FORECAST)} select mgra, increment from pop_ase_mgra intersect
    select mgra, increment from hh_characteristics_mgra intersect select mgra, increment from mgrabase""",
)
def _(spark, sf):
    ase, hh, base = [standin(spark, sf, name).select("mgra", "increment") for name in FORECAST]
    return ase.intersect(hh).intersect(base)


GQ = """gq as (
  select mgra, increment, 'gq_mil' as synthesis_run, 'GQ_Military' as control_field, gq_mil_pop as Total_GQ from inc
  union all select mgra, increment, 'gq_col', 'GQ_College', gq_college_pop from inc
  union all select mgra, increment, 'gq_oth', 'GQ_Other', gq_other_pop from inc)"""


@query("p15_gq_controls", f"{ctes('mgrabase')}, {INC}, {GQ} select * from gq where Total_GQ > 0")
def _(spark, sf):
    return controls.gq_controls(controls.income_and_gq_controls(standin(spark, sf, "mgrabase")))


@query(
    "a04_regional_military",
    f"{ctes('mgrabase')} select increment, cast(sum(gq_mil) as bigint) as gq_mil from mgrabase group by increment",
)
def _(spark, sf):
    return controls.regional_military(standin(spark, sf, "mgrabase"))


LONG = "long as (" + " union all ".join(
    f'select region, Label, {y} as year, "{y}" as value from economic_controls where Label is not null' for y in YEARS
) + ")"


def as_doubles(df, columns):
    """Amounts are summed as decimals, which is exact in any order, and shown as doubles."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


@query(
    "r03_years_to_rows",
    f"{ctes('economic_controls')}, {LONG} select region, Label, year, cast(value as double) as value from long",
)
def _(spark, sf):
    return as_doubles(controls.economic_long(standin(spark, sf, "economic_controls"), YEARS), ["value"])


def _pivot(adjust: bool) -> str:
    column = lambda l: f"sum(case when Label = '{l}' then value end)"
    return ", ".join(
        "cast(" + (f"{column(l)} - any_value(gq_mil)" if adjust and l == "job_2" else column(l)) + f" as double) as {l}"
        for l in ECONOMIC_LABELS
    )


@query(
    "a05_economic_pivot",
    f"{ctes('economic_controls')}, {LONG} select region, year, {_pivot(False)} from long group by region, year",
)
def _(spark, sf):
    return as_doubles(controls.economic_controls(standin(spark, sf, "economic_controls"), YEARS), ECONOMIC_LABELS)


@query(
    "j12_region_controls",
    f"""{ctes('economic_controls', 'mgrabase')}, {LONG},
    military as (select increment, sum(gq_mil) as gq_mil from mgrabase group by increment)
    select region, year, {_pivot(True)} from long left join military on year = increment group by region, year""",
)
def _(spark, sf):
    rows = controls.region_controls(standin(spark, sf, "economic_controls"), standin(spark, sf, "mgrabase"), YEARS)
    return as_doubles(rows, ECONOMIC_LABELS)
