"""Seed build: classification, household and person seeds, splits and numbering."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.registry import query
from suite.standins import ctes, standin
from zonecraft.functions import seed as fn
from zonecraft.operators import seed
from zonecraft.session import new_stage_path
from zonecraft.sources import tables

H = "household_src"
P = "person_src"

GQ_SQL = """case when TYPEHUGQ = 1 then 0 when TYPEHUGQ = 3 and MIL = 1 then 1
  when TYPEHUGQ = 3 and SCHG in (15, 16) then 2 when TYPEHUGQ in (2, 3) then 3 end"""
RACE_SQL = """case when HISP <> '01' then 'Hispanic' when RAC1P = '1' then 'White alone'
  when RAC1P = '2' then 'Black or African American alone' when RAC1P = '6' then 'Asian alone'
  when RAC1P = '9' then 'Two or More Races' when RAC1P in ('3', '4', '5', '7', '8') then 'Other' end"""
NAICS_SQL = """case when left(NAICSP, 4) = '9281' then 'MIL' when left(NAICSP, 2) = '72' then left(NAICSP, 3)
  else left(NAICSP, 2) end"""
CPI_SQL = """case left(SERIALNO, 4) when '2017' then 283.012e0 when '2018' then 292.547e0 when '2019' then 299.433e0
  when '2020' then 303.932e0 when '2021' then 319.761e0 end"""
WORKER_SQL = "case when ESR in (1, 2, 4, 5) then 1 else 0 end"
LABOR_SQL = "case when ESR in (1, 2, 3, 4, 5) then 1 else 0 end"

ROLLUP = f"""rollup_src as (select SERIALNO, cast(sum({WORKER_SQL}) as bigint) as workers, max(MIL) as MIL,
  max(SCHG) as SCHG, max(PWGTP) as PWGTP, max(PINCP) as PINCP from person_src group by SERIALNO)"""

SEED_HH = f"""{ROLLUP}, seed_hh as (select h.SERIALNO, PUMA, NP, HINCP,
  round(case when TYPEHUGQ in (2, 3) then PINCP else HINCP end * 344.416e0 / ({CPI_SQL.replace('SERIALNO', 'h.SERIALNO')}),
    0) as HHADJINC,
  HHT, workers, HUPAC, VEH, BLD, TYPEHUGQ, {GQ_SQL} as gq_type,
  case when TYPEHUGQ = 1 then WGTP when TYPEHUGQ in (2, 3) then PWGTP end as WGTP
  from household_src h join rollup_src r on h.SERIALNO = r.SERIALNO where NP > 0)"""

SEED_PP = f"""seed_pp as (select p.SERIALNO, SPORDER, h.PUMA, AGEP, SEX, ESR, {LABOR_SQL} as laborforce,
  {WORKER_SQL} as worker, COW, WKHP, coalesce(SCHG, 0) as SCHG, HISP, RAC1P, {RACE_SQL} as race, MIL, SCHL, OCCP, WKW,
  NAICSP, {NAICS_SQL} as NAICS2, SOCP, left(SOCP, 2) as SOC2, p.TYPEHUGQ,
  {GQ_SQL.replace('TYPEHUGQ', 'p.TYPEHUGQ')} as gq_type, PINCP
  from person_src p join household_src h on p.SERIALNO = h.SERIALNO where NP > 0)"""


def households(spark, sf):
    return standin(spark, sf, H)


def persons(spark, sf):
    return standin(spark, sf, P)


def seed_hh(spark, sf):
    return seed.seed_households(households(spark, sf), persons(spark, sf))


def seed_pp(spark, sf):
    return seed.seed_persons(persons(spark, sf), households(spark, sf))


@query("s03_read_microdata", f"{ctes(P)} select SERIALNO, SPORDER, AGEP, SEX, RAC1P from person_src")
def _(spark, sf):
    path = new_stage_path(spark, "microdata")
    persons(spark, sf).write.parquet(path)
    return tables.read_microdata(spark, path, ["SERIALNO", "SPORDER", "AGEP", "SEX", "RAC1P"])


@query(
    "p01_adjust_income",
    f"""{ctes(H, P)}, {SEED_HH} select SERIALNO, HHADJINC from seed_hh""",
)
def _(spark, sf):
    return seed_hh(spark, sf).select("SERIALNO", "HHADJINC")


@query("p02_gq_type", f"{ctes(P)} select gq, count(*) as n from (select {GQ_SQL} as gq from person_src) t group by gq")
def _(spark, sf):
    kind = fn.gq_type(F.col("TYPEHUGQ"), F.col("MIL"), F.col("SCHG"))
    return persons(spark, sf).groupBy(kind.alias("gq")).agg(F.count("*").alias("n"))


@query("p03_seed_weight", f"{ctes(H, P)}, {SEED_HH} select SERIALNO, WGTP from seed_hh")
def _(spark, sf):
    return seed_hh(spark, sf).select("SERIALNO", "WGTP")


@query(
    "p04_labor_force_flag",
    f"""{ctes(P)} select ESR, {LABOR_SQL} as laborforce, count(*) as n from person_src group by ESR, {LABOR_SQL}""",
)
def _(spark, sf):
    flag = fn.in_labor_force(F.col("ESR")).alias("laborforce")
    return persons(spark, sf).groupBy("ESR", flag).agg(F.count("*").alias("n"))


@query(
    "p05_worker_flag",
    f"""{ctes(P)} select ESR, {WORKER_SQL} as worker, count(*) as n from person_src group by ESR, {WORKER_SQL}""",
)
def _(spark, sf):
    flag = fn.is_worker(F.col("ESR")).alias("worker")
    return persons(spark, sf).groupBy("ESR", flag).agg(F.count("*").alias("n"))


@query("p06_school_default", f"{ctes(H, P)}, {SEED_PP} select SCHG, count(*) as n from seed_pp group by SCHG")
def _(spark, sf):
    return seed_pp(spark, sf).groupBy("SCHG").agg(F.count("*").alias("n"))


@query(
    "p07_race",
    f"{ctes(P)} select HISP, RAC1P, {RACE_SQL} as race, count(*) as n from person_src group by HISP, RAC1P, {RACE_SQL}",
)
def _(spark, sf):
    label = fn.race(F.col("HISP"), F.col("RAC1P")).alias("race")
    return persons(spark, sf).groupBy("HISP", "RAC1P", label).agg(F.count("*").alias("n"))


@query(
    "p10_industry_sector",
    f"{ctes(P)} select NAICSP, {NAICS_SQL} as NAICS2, count(*) as n from person_src group by NAICSP, {NAICS_SQL}",
)
def _(spark, sf):
    sector = fn.industry_sector(F.col("NAICSP")).alias("NAICS2")
    return persons(spark, sf).groupBy("NAICSP", sector).agg(F.count("*").alias("n"))


@query(
    "p11_occupation_group",
    f"{ctes(P)} select left(SOCP, 2) as SOC2, count(*) as n from person_src group by left(SOCP, 2)",
)
def _(spark, sf):
    return persons(spark, sf).groupBy(fn.occupation_group(F.col("SOCP")).alias("SOC2")).agg(F.count("*").alias("n"))


@query("p12_occupied", f"{ctes(H)} select SERIALNO, NP from household_src where NP > 0")
def _(spark, sf):
    return seed.occupied(households(spark, sf)).select("SERIALNO", "NP")


@query(
    "p13_split_group_quarters",
    f"""{ctes(H)} select TYPEHUGQ in (2, 3) as is_gq, count(*) as n, cast(sum(WGTP) as bigint) as weight
    from household_src where TYPEHUGQ in (1, 2, 3) group by 1""",
)
def _(spark, sf):
    marked = seed.mark_group_quarters(households(spark, sf))
    return marked.groupBy("is_gq").agg(F.count("*").alias("n"), F.sum("WGTP").alias("weight"))


RUN_SQL = "case gq_type when 0 then 'household' when 1 then 'gq_mil' when 2 then 'gq_col' when 3 then 'gq_oth' end"


@query(
    "p14_split_runs",
    f"""{ctes(H, P)}, {SEED_HH} select SERIALNO, {RUN_SQL} as synthesis_run from seed_hh where gq_type is not null""",
)
def _(spark, sf):
    return seed.split_runs(seed_hh(spark, sf)).select("SERIALNO", "synthesis_run")


@query("a03_person_rollup", f"{ctes(P)}, {ROLLUP} select * from rollup_src")
def _(spark, sf):
    return seed.person_rollup(persons(spark, sf))


@query("j01_seed_households", f"{ctes(H, P)}, {SEED_HH} select * from seed_hh")
def _(spark, sf):
    return seed_hh(spark, sf)


@query("j02_seed_persons", f"{ctes(H, P)}, {SEED_PP} select * from seed_pp")
def _(spark, sf):
    return seed_pp(spark, sf)


@query(
    "j04_persons_of_run",
    f"""{ctes(H, P)}, {SEED_HH} select SERIALNO, SPORDER, AGEP from person_src
    where SERIALNO in (select SERIALNO from seed_hh where gq_type = 3)""",
)
def _(spark, sf):
    chosen = seed.split_runs(seed_hh(spark, sf)).where("synthesis_run = 'gq_oth'")
    return seed.persons_of(persons(spark, sf), chosen, "SERIALNO").select("SERIALNO", "SPORDER", "AGEP")


@query(
    "a20_run_profile",
    f"""{ctes(H, P)}, {SEED_HH}, runs as (select {RUN_SQL} as synthesis_run, count(*) as n from seed_hh group by 1)
    select r.synthesis_run, coalesce(n, 0) as n, n is null as is_empty
    from (values ('gq_mil'), ('gq_col'), ('gq_oth'), ('household')) r(synthesis_run)
    left join runs on runs.synthesis_run = r.synthesis_run""",
)
def _(spark, sf):
    return seed.empty_runs(seed.split_runs(seed_hh(spark, sf)))


@query(
    "w01_assign_hhid",
    f"""{ctes(H, P)}, numbered as (select is_gq, SERIALNO,
      row_number() over (partition by is_gq order by SERIALNO) as hhid
      from (select distinct TYPEHUGQ in (2, 3) as is_gq, SERIALNO from household_src) k)
    select p.SERIALNO, SPORDER, is_gq, hhid from person_src p join numbered n
    on n.SERIALNO = p.SERIALNO and n.is_gq = (TYPEHUGQ in (2, 3))""",
)
def _(spark, sf):
    _, numbered = seed.assign_hhid(households(spark, sf), persons(spark, sf))
    return numbered.select("SERIALNO", "SPORDER", "is_gq", "hhid")


@query(
    "o02_sorted_persons",
    f"{ctes(P)} select SERIALNO, SPORDER, AGEP, SEX from person_src order by SERIALNO, SPORDER",
)
def _(spark, sf):
    return seed.sorted_output(persons(spark, sf).select("SERIALNO", "SPORDER", "AGEP", "SEX"), "SERIALNO", "SPORDER")
