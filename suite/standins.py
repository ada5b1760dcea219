"""Stand-in inputs over the test tables, as SQL text that Spark and DuckDB read alike.

Roles: an order is a household, a line item is a person, a customer is a zone (mgra), a nation is a PUMA. Both sides of
the correctness check start from the same stand-in text; the operators under test are written separately in each.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from zonecraft.definitions import AGE_BANDS, INCOME_BANDS, MGRABASE_COLUMNS

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _serialno(key: str) -> str:
    return f"concat(cast(2017 + {key} % 5 as string), lpad(cast({key} as string), 12, '0'))"


def _typehugq(key: str) -> str:
    return f"cast(case when {key} % 10 = 3 then 2 when {key} % 10 = 7 then 3 else 1 end as int)"


def _flag(condition: str, name: str) -> str:
    return f"cast(case when {condition} then 1 else 0 end as int) as {name}"


def _count(condition: str, name: str) -> str:
    return f"cast(sum(case when {condition} then 1 else 0 end) as bigint) as {name}"


YEAR = "cast(year(o_orderdate) + 27 as int)"

STANDINS: dict[str, str] = {}

STANDINS["person_src"] = f"""
select {_serialno('l_orderkey')} as SERIALNO, l_orderkey as household_id, l_linenumber as SPORDER,
  cast(l_quantity * 2 - 2 as int) as AGEP, cast(1 + l_partkey % 2 as int) as SEX,
  cast(case when l_linenumber = 7 then null else l_linenumber end as int) as ESR,
  cast(case when l_suppkey % 4 = 0 then null else 1 + l_suppkey % 9 end as int) as COW,
  cast(case when l_partkey % 5 = 0 then null else 10 + l_partkey % 60 end as int) as WKHP,
  cast(case when l_partkey % 11 = 0 then 15 when l_partkey % 11 = 1 then 16 when l_partkey % 11 = 2 then null else 1 end
    as int) as SCHG,
  case when l_suppkey % 29 = 0 then null when l_suppkey % 5 = 0 then '02' else '01' end as HISP,
  case when l_partkey % 41 = 0 then '0' else cast(1 + l_partkey % 9 as string) end as RAC1P,
  cast(case when l_orderkey % 30 = 7 then 1 when l_suppkey % 17 = 0 then 2 else 4 end as int) as MIL,
  cast(case when l_suppkey % 6 = 0 then null else 1 + l_suppkey % 24 end as int) as SCHL,
  cast(case when l_partkey % 13 = 0 then null else l_partkey % 980 end as int) as OCCP,
  cast(case when l_partkey % 3 = 0 then null else 1 + l_partkey % 6 end as int) as WKW,
  case l_partkey % 10 when 0 then '928110' when 1 then '722511' when 2 then '7211' when 3 then '92' when 4 then '5411'
    when 5 then '4M' when 6 then null when 7 then '62' when 8 then '311' else '23' end as NAICSP,
  case when l_partkey % 7 = 0 then null else cast(110000 + l_partkey % 400000 as string) end as SOCP,
  {_typehugq('l_orderkey')} as TYPEHUGQ, l_extendedprice as PINCP, cast(1 + l_linenumber as int) as PWGTP
from lineitem"""

STANDINS["household_src"] = f"""
select {_serialno('o.o_orderkey')} as SERIALNO, o.o_orderkey as household_id, o.o_custkey as mgra,
  cast(7301 + c.c_nationkey as int) as PUMA, cast(coalesce(p.np, 0) as int) as NP,
  case when o.o_orderkey % 50 = 0 then null else o.o_totalprice - 5000 end as HINCP,
  cast(case when o.o_orderkey % 10 = 0 then null else 1 + o.o_orderkey % 7 end as int) as HHT,
  cast(case when o.o_orderkey % 9 = 0 then null else 1 + o.o_orderkey % 4 end as int) as HUPAC,
  cast(o.o_orderkey % 6 as int) as VEH, cast(case when o.o_orderkey % 8 = 0 then null else 1 + o.o_orderkey % 10 end
    as int) as BLD,
  {_typehugq('o.o_orderkey')} as TYPEHUGQ, cast(1 + o.o_orderkey % 5 as int) as WGTP, {YEAR} as survey_wave
from orders o join customer c on o.o_custkey = c.c_custkey
left join (select l_orderkey, count(*) as np from lineitem group by l_orderkey) p on p.l_orderkey = o.o_orderkey"""

STANDINS["geo_cross_walk"] = """
select c_custkey as mgra, cast(7301 + c_nationkey as int) as PUMA, cast(1 + n_regionkey as int) as region
from customer join nation on c_nationkey = n_nationkey"""

STANDINS["pop_ase_mgra"] = f"""
select o_custkey as mgra, {YEAR} as increment, cast(1 + l_partkey % 2 as int) as sex_id,
  cast(1 + l_suppkey % 21 as int) as age_group_id, cast(1 + l_partkey % 8 as int) as ethnicity_id,
  cast(l_quantity as int) as hhp
from lineitem join orders on l_orderkey = o_orderkey"""

STANDINS["hh_characteristics_mgra"] = f"""
select o_custkey as mgra, {YEAR} as increment,
  {', '.join(_flag(f'o_orderkey % 7 = {k - 1}', f'hhs{k}') for k in range(1, 8))},
  {', '.join(_flag(f'o_orderkey % 4 = {k}', f'hhworkers{k}') for k in range(4))},
  {_flag('o_orderkey % 3 = 0', 'hhwoc')}, {_flag('o_orderkey % 3 <> 0', 'hhwc')}
from orders"""

STANDINS["mgrabase"] = f"""
select o_custkey as mgra, {YEAR} as increment,
  {', '.join(_count(f'o_orderkey % 10 = {k - 1}', f'i{k}') for k in range(1, 11))},
  {_count("o_orderkey % 13 = 0", 'gq_civ_college')}, {_count("o_orderkey % 17 = 0", 'gq_mil')},
  {_count("o_orderkey % 19 = 0", 'gq_civ_other')}
from orders group by o_custkey, {YEAR}"""

# Every remaining land-use column is a count by zone and year with its own modulus, so all columns differ.
_LAND_USE = [c for c in MGRABASE_COLUMNS if c not in ("mgra", "gq_mil") and not re.fullmatch(r"i\d+", c)]
STANDINS["mgrabase_wide"] = f"""
select o_custkey as mgra, {YEAR} as increment,
  {', '.join(_count(f'o_orderkey % 10 = {k - 1}', f'i{k}') for k in range(1, 11))},
  {_count("o_orderkey % 17 = 0", 'gq_mil')},
  {', '.join(_count(f'o_orderkey % {k + 2} = 1', 'emp_tot' if c == 'emp_total' else c) for k, c in enumerate(_LAND_USE))}
from orders group by o_custkey, {YEAR}"""

STANDINS["economic_controls"] = """
select cast(1 + user_id % 5 as int) as region, event_type as Control,
  case when event_id % 20 >= 18 then null when event_id % 20 < 14
      then concat('job_', cast(1 + event_id % 20 as string))
    when event_id % 20 = 14 then 'lfp_black' when event_id % 20 = 15 then 'lfp_hispanic'
    when event_id % 20 = 16 then 'lfp_other' else 'lfp_white' end as Label,
  cast(value as decimal(18, 2)) as "2022", cast(value + 1 as decimal(18, 2)) as "2023",
  cast(value * 2 as decimal(18, 2)) as "2024", cast(value + user_id as decimal(18, 2)) as "2025",
  cast(value + event_id % 7 as decimal(18, 2)) as "2026", cast(value as decimal(18, 2)) as "2027",
  cast(value + 3 as decimal(18, 2)) as "2028"
from events"""

# A finished population: every order one household with its final attributes, every line item one person.
STANDINS["synthetic_households"] = f"""
select o_orderkey as household_id, o_custkey as mgra, {YEAR} as year, {_serialno('o_orderkey')} as SERIALNO,
  cast(1 + o_orderkey % 6 as int) as NP, o_totalprice - 5000 as HHADJINC,
  cast(case when o_orderkey % 10 = 0 then null else 1 + o_orderkey % 7 end as int) as HHT,
  cast(case when o_orderkey % 9 = 0 then null else 1 + o_orderkey % 4 end as int) as HUPAC,
  cast(o_orderkey % 6 as int) as VEH,
  cast(case when o_orderkey % 8 = 0 then null else 1 + o_orderkey % 10 end as int) as BLD,
  cast(case when o_orderkey % 10 < 7 then 0 else o_orderkey % 10 - 6 end as int) as gq_type,
  cast(o_orderkey % 4 as int) as workers, cast(1 + o_orderkey % 5 as int) as WGTP,
  case when o_orderkey % 10 < 7 then 'household' when o_orderkey % 10 = 7 then 'gq_mil'
    when o_orderkey % 10 = 8 then 'gq_col' else 'gq_oth' end as synthesis_run
from orders"""

_TARGETS = {
    "Total_HH": "o_orderkey >= 0",
    **{f"HHSize_{k}": f"o_orderkey % 6 = {k - 1}" for k in (1, 2, 3)},
    "HHSize_4Plus": "o_orderkey % 6 >= 3",
    "HHWork_0": "o_orderkey % 4 = 0",
    "HHWork_1": "o_orderkey % 4 = 1",
    "HHInc_200000Plus": "o_totalprice >= 205000",
    "HHChild_0": "o_orderkey % 3 = 0",
    "Male": "o_orderkey % 5 <= 2",
    "Total_Pop": "o_orderkey % 7 <= 5",
    "Age_85Plus": "o_orderkey % 9 = 4",
    "Asian": "o_orderkey % 8 = 3",
    "GQ_Military": "o_orderkey % 10 = 7",
    "job_1": "o_orderkey % 11 = 2",
    "lfp_black": "o_orderkey % 12 = 5",
    "Mystery": "o_orderkey % 14 = 6",
}
SUMMARY_TARGETS = list(_TARGETS)

STANDINS["summary_mgra"] = f"""
select 'mgra' as geography, id, {', '.join(
    f'greatest({t}_result + (id + {k}) % 3 - 1, 0) as {t}_control, {t}_result' for k, t in enumerate(SUMMARY_TARGETS))}
from (select o_custkey as id, {', '.join(_count(c, f'{t}_result') for t, c in _TARGETS.items())}
  from orders group by o_custkey) counted"""

STANDINS["summary_puma"] = f"""
select 'PUMA' as geography, PUMA as id, {', '.join(
    f'cast(sum({t}_control) as bigint) as {t}_control, cast(sum({t}_result) as bigint) as {t}_result'
    for t in SUMMARY_TARGETS)}
from summary_mgra join geo_cross_walk on id = mgra group by PUMA"""

STANDINS["definitions"] = f"""
select target, control_field, geography, min(ordinal) as ordinal, min(ordinal) + 100 as control_id from (
  select case o_orderkey % {len(SUMMARY_TARGETS)} {' '.join(
      f"when {k} then '{t}'" for k, t in enumerate(SUMMARY_TARGETS))} end as target,
    case o_orderkey % {len(SUMMARY_TARGETS)} {' '.join(
      f"when {k} then '{t}'" for k, t in enumerate(SUMMARY_TARGETS))} end as control_field,
    'mgra' as geography, o_orderkey % {len(SUMMARY_TARGETS)} as ordinal from orders) listed
where target <> 'Mystery' group by target, control_field, geography"""

# Long totals of many runs: one row per run, control and zone, with NULL controls among them.
STANDINS["control_totals"] = f"""
select cast(year(o_orderdate) as int) as run_id, cast(100 + o_orderkey % {len(SUMMARY_TARGETS)} as bigint) as control_id,
  'mgra' as geography, o_custkey as geography_id,
  cast(case when o_orderkey % 23 = 0 then null else (o_orderkey % 4) * (1 + o_custkey % 9) end as bigint)
    as control_value,
  cast(o_orderkey % 5 + o_custkey % 9 as bigint) as result,
  case when o_orderkey % 6 = 0 then 'Benchmark Only' else 'Fitting Control' end as Status
from orders"""

# A run log: four consecutive events are one run; the event type is the table that was written.
STANDINS["run_log"] = """
select concat(case when user_id % 9 = 0 then 'trial' else cast(2022 + user_id % 7 as string) end, '_s',
    cast(cast(floor(event_id / 4) as bigint) as string)) as run,
  cast(floor(event_id / 4) as bigint) as run_id, event_type as table_name, ts, value, event_id
from events"""

STANDINS["step_log"] = """
select cast(floor(event_id / 10) as bigint) as run_id,
  case event_type when 'view' then 'initial_seed_balancing' when 'click' then 'final_seed_balancing'
    when 'error' then 'sub_balancing.geography=mgra' when 'purchase' then 'expand_households' else 'summarize' end
    as model_name, event_id, cast(value as decimal(18, 2)) as seconds from events"""

_NEEDS = {
    name: [other for other in STANDINS if other != name and re.search(rf"\b{other}\b", text)]
    for name, text in STANDINS.items()
}


def _closure(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(name: str) -> None:
        for other in _NEEDS[name]:
            visit(other)
        if name not in seen:
            seen.append(name)

    for name in names:
        visit(name)
    return seen


def ctes(*names: str) -> str:
    """``with`` clause (DuckDB) that defines the named stand-ins and what they are built on."""
    return "with " + ",\n".join(f"{name} as ({STANDINS[name]})" for name in _closure(names))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def standin(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The stand-in as a lazy DataFrame; only the columns a query uses reach the scans."""
    text = STANDINS[name].replace('"', "`")
    inputs = {t: table(spark, sf_dir, t) for t in BASE_TABLES if re.search(rf"\b(from|join) {t}\b", text)}
    inputs |= {n: standin(spark, sf_dir, n) for n in _NEEDS[name]}
    for used in inputs:
        text = re.sub(rf"\b(from|join) {used}\b", rf"\1 {{{used}}}", text)
    return spark.sql(text, **inputs)


assert len(AGE_BANDS) == 12 and len(INCOME_BANDS) == 7
