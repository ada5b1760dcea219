"""Predicates, incidence, area counts and roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.control_queries import ASE, FORECAST, ZONES, zones
from suite.registry import query
from suite.seed_queries import RACE_SQL, SEED_HH, SEED_PP, H, P, households, persons, seed_hh, seed_pp
from suite.standins import ctes, standin
from zonecraft import definitions as d
from zonecraft.operators import controls as control_ops
from zonecraft.operators import incidence as ops

FITTING = d.fitting_controls()
HH_CONTROLS = ops.of_table(FITTING, "households")
PP_CONTROLS = ops.of_table(FITTING, "persons")
REPORTING = d.reporting_controls()


def duck(control) -> str:
    return control.predicate.replace("double('infinity')", "'infinity'::double")


def count_sql(controls) -> str:
    return ", ".join(f"count(*) filter (where {duck(c)}) as {c.target}" for c in controls)


INCIDENCE = f"""{SEED_HH}, {SEED_PP}, inc_rows as (select SERIALNO as hhid, PUMA, WGTP,
  {', '.join(f'cast(coalesce({duck(c)}, false) as int) as {c.target}' for c in HH_CONTROLS)},
  {', '.join(f'coalesce({c.target}, 0) as {c.target}' for c in PP_CONTROLS)}
  from seed_hh left join (select SERIALNO as s, {count_sql(PP_CONTROLS)} from seed_pp group by SERIALNO) m
  on s = SERIALNO)"""


def keyed(spark, sf):
    return (
        seed_hh(spark, sf).withColumnRenamed("SERIALNO", "hhid"),
        seed_pp(spark, sf).withColumnRenamed("SERIALNO", "hhid"),
    )


def incidence_rows(spark, sf, controls=None):
    rows = ops.survey_incidence(households(spark, sf), persons(spark, sf), controls or FITTING, keep=("PUMA", "WGTP"))
    return rows.withColumnRenamed("SERIALNO", "hhid")


@query(
    "p19_control_predicates",
    f"""{ctes(H, P)}, {SEED_HH}, {SEED_PP},
    hh as (select {count_sql(HH_CONTROLS + REPORTING)} from seed_hh), pp as (select {count_sql(PP_CONTROLS)} from seed_pp)
    select * from (unpivot hh on * into name target value matches)
    union all select * from (unpivot pp on * into name target value matches)""",
)
def _(spark, sf):
    hh = ops.count_by(seed_hh(spark, sf), [], HH_CONTROLS + REPORTING)
    pp = ops.count_by(seed_pp(spark, sf), [], PP_CONTROLS)
    long = lambda wide: wide.unpivot([], wide.columns, "target", "matches")
    return long(hh).unionByName(long(pp))


@query("y01_incidence", f"{ctes(H, P)}, {INCIDENCE} select * from inc_rows")
def _(spark, sf):
    return ops.incidence(*keyed(spark, sf), FITTING, keep=("PUMA", "WGTP"))


SYN_PP = f"""syn_pp as (select p.*, h.mgra, {RACE_SQL} as race from person_src p
  join synthetic_households h on h.household_id = p.household_id)"""


def synthetic_persons(spark, sf):
    """Persons with the zone of their household."""
    zones = standin(spark, sf, "synthetic_households").select("household_id", "mgra")
    return standin(spark, sf, P).join(zones, "household_id")


@query(
    "a06_benchmark_count",
    f"""{ctes('synthetic_households')}, c as (select mgra, {count_sql(REPORTING)}
      from synthetic_households where gq_type = 0 group by mgra)
    select mgra, target, result from (unpivot c on HHChild_0, HHChild_1Plus into name target value result)""",
)
def _(spark, sf):
    population = standin(spark, sf, "synthetic_households").where("gq_type = 0")
    return ops.counts_long(population, ["mgra"], REPORTING)


ZONE_TARGETS = [c.target for c in FITTING if c.geography == "mgra"]


def ase(spark, sf):
    return control_ops.population_controls(standin(spark, sf, "pop_ase_mgra"))


@query(
    "j06_crosswalk_join",
    f"""{ctes('pop_ase_mgra', 'geo_cross_walk')}, {ASE} select ase.mgra, increment, Total_Pop, PUMA
    from ase left join geo_cross_walk x on x.mgra = ase.mgra""",
)
def _(spark, sf):
    rows = ops.with_puma(ase(spark, sf), standin(spark, sf, "geo_cross_walk"), "mgra")
    return rows.select("mgra", "increment", "Total_Pop", "PUMA")


@query(
    "y03_seed_targets",
    f"""{ctes(*FORECAST, 'geo_cross_walk')}, {ZONES} select PUMA, increment,
    {', '.join(f'cast(sum({t}) as bigint) as {t}' for t in ZONE_TARGETS)}
    from zones join geo_cross_walk using (mgra) group by PUMA, increment""",
)
def _(spark, sf):
    crosswalk = standin(spark, sf, "geo_cross_walk")
    return ops.puma_targets(zones(spark, sf), crosswalk, ZONE_TARGETS, keep=("increment",))


@query(
    "a18_hierarchy_rollup",
    f"""{ctes('pop_ase_mgra', 'geo_cross_walk')}, {ASE} select
    case grouping_id(region, PUMA, mgra) when 0 then 'mgra' when 1 then 'PUMA' when 3 then 'region' else 'all' end as level,
    region, PUMA, mgra, cast(sum(Total_Pop) as bigint) as Total_Pop, cast(sum(Male) as bigint) as Male
    from ase join geo_cross_walk using (mgra) group by rollup (region, PUMA, mgra)""",
)
def _(spark, sf):
    return ops.hierarchy_totals(ase(spark, sf), standin(spark, sf, "geo_cross_walk"), ["Total_Pop", "Male"])


SIG_TARGETS = [c.target for c in HH_CONTROLS if c.target.startswith(("HHSize", "HHWork"))] + ["Male", "Female"]
SIG_CONTROLS = [c for c in FITTING if c.target in SIG_TARGETS]
SIGS = f"""sigs as (select PUMA, {', '.join(SIG_TARGETS)}, cast(sum(WGTP) as bigint) as w0, count(*) as members,
  min(hhid) as sig from inc_rows group by PUMA, {', '.join(SIG_TARGETS)})"""


@query("y02_group_signature", f"{ctes(H, P)}, {INCIDENCE}, {SIGS} select * from sigs")
def _(spark, sf):
    return ops.signatures(incidence_rows(spark, sf, SIG_CONTROLS), ["PUMA"], SIG_TARGETS)


@query(
    "y02_split_signature",
    f"""{ctes(H, P)}, {INCIDENCE}, {SIGS} select hhid, round(WGTP * ((w0 * 1.5e0 + members) / w0), 4) as w
    from inc_rows join sigs using (PUMA, {', '.join(SIG_TARGETS)})""",
)
def _(spark, sf):
    rows = incidence_rows(spark, sf, SIG_CONTROLS)
    merged = ops.signatures(rows, ["PUMA"], SIG_TARGETS)
    weighted = merged.withColumn("w", F.col("w0") * 1.5 + F.col("members"))
    return ops.split_signatures(rows, weighted, ["PUMA"], SIG_TARGETS).select("hhid", F.round("w", 4).alias("w"))
