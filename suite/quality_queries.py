"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.control_queries import ASE, FORECAST, LONG, YEARS, ZONES, as_doubles, ase_rows, zones
from suite.registry import query
from suite.report_queries import MELT, SM, SP
from suite.seed_queries import SEED_HH, SEED_PP, H, P, households, persons, seed_hh, seed_pp
from suite.standins import ctes, standin
from zonecraft.definitions import ECONOMIC_LABELS
from zonecraft.operators import controls, quality, reshape

X = "geo_cross_walk"
SH = "synthetic_households"
ECON = "economic_controls"


@query(
    "q01_person_linkage",
    f"""{ctes(H, P)} select SERIALNO, SPORDER from person_src
    where SERIALNO not in (select SERIALNO from household_src where TYPEHUGQ = 1)""",
)
def _(spark, sf):
    regular = households(spark, sf).where("TYPEHUGQ = 1")
    return quality.orphans(persons(spark, sf).select("SERIALNO", "SPORDER"), regular, "SERIALNO")


@query(
    "j15_households_without_person",
    f"""{ctes(H, P)} select SERIALNO, mgra from household_src
    where SERIALNO not in (select SERIALNO from person_src)""",
)
def _(spark, sf):
    return quality.orphans(households(spark, sf).select("SERIALNO", "mgra"), persons(spark, sf), "SERIALNO")


NULLABLE = ["AGEP", "ESR", "COW", "WKHP", "SCHG", "HISP", "NAICSP", "SOCP"]


@query(
    "q02_null_counts",
    f"""{ctes(P)}, c as (select {', '.join(f'count(*) filter (where {c} is null) as {c}' for c in NULLABLE)} from person_src)
    select "column", nulls from (unpivot c on {', '.join(NULLABLE)} into name "column" value nulls)""",
)
def _(spark, sf):
    return quality.null_counts(persons(spark, sf), NULLABLE)


@query(
    "q03_coverage",
    f"""{ctes(H)} select count(distinct PUMA) as areas, cast(sum(WGTP) as bigint) as weight, count(*) as records
    from household_src""",
)
def _(spark, sf):
    return quality.coverage(households(spark, sf), "PUMA", "WGTP")


@query(
    "q04_missing_classification",
    f"""{ctes(H)} select count(*) as violations, count(*) = 0 as passed, 'gq_type' as "check" from
    (select case when TYPEHUGQ = 1 then 0 when TYPEHUGQ = 3 then 3 end as gq_type from household_src) t
    where gq_type is null""",
)
def _(spark, sf):
    typed = households(spark, sf).withColumn("gq_type", F.expr("case TYPEHUGQ when 1 then 0 when 3 then 3 end"))
    return quality.verdict("gq_type", quality.missing_classification(typed))


@query(
    "q05_duplicate_keys",
    f"""{ctes(P)} select SERIALNO, SPORDER, count(*) as n from person_src group by SERIALNO, SPORDER having count(*) > 1""",
)
def _(spark, sf):
    return quality.duplicate_keys(persons(spark, sf), ["SERIALNO", "SPORDER"])


@query(
    "q06_missing_crosswalk",
    f"""{ctes('pop_ase_mgra', X)} select distinct mgra from pop_ase_mgra
    where mgra not in (select mgra from geo_cross_walk where region = 1)""",
)
def _(spark, sf):
    part = standin(spark, sf, X).where("region = 1")
    return quality.missing_in_crosswalk(standin(spark, sf, "pop_ase_mgra"), part)


@query(
    "q07_household_sizes",
    f"""{ctes(*FORECAST)}, {ZONES}, c as (select mgra, increment, Total_HH + mgra % 2 as Total_HH, HHSize_1, HHSize_2,
    HHSize_3, HHSize_4Plus from zones) select *, Total_HH - HHSize_1 - HHSize_2 - HHSize_3 - HHSize_4Plus as gap from c
    where abs(Total_HH - HHSize_1 - HHSize_2 - HHSize_3 - HHSize_4Plus) >= 1""",
)
def _(spark, sf):
    sizes = ["HHSize_1", "HHSize_2", "HHSize_3", "HHSize_4Plus"]
    wrong = (F.col("Total_HH") + F.col("mgra") % 2).alias("Total_HH")
    return quality.household_size_gap(zones(spark, sf).select("mgra", "increment", wrong, *sizes))


AGES = "Age_LT5 + Age_5to9 + Age_10to14 + Age_15to17 + Age_18to24 + Age_25to34 + Age_35to44 + Age_45to54 + Age_55to64"
AGES += " + Age_65to74 + Age_75to84 + Age_85Plus"


@query(
    "q08_population_sums",
    f"""{ctes('pop_ase_mgra')}, {ASE}, s as (select mgra, increment, {AGES} as by_age, Male + mgra % 3 + Female as by_sex,
    Asian + Black + Hispanic + Other + Two_or_more + White as by_race from ase)
    select * from s where by_age <> by_sex or by_sex <> by_race""",
)
def _(spark, sf):
    rows = ase_rows(spark, sf).withColumn("Male", F.col("Male") + F.col("mgra") % 3)
    return quality.population_gap(rows).select("mgra", "increment", "by_age", "by_sex", "by_race")


@query(
    "q09_crosswalk_in_controls",
    f"""{ctes('pop_ase_mgra', X)} select mgra, PUMA, region from geo_cross_walk
    where mgra not in (select mgra from pop_ase_mgra where increment = 2028)""",
)
def _(spark, sf):
    one_year = standin(spark, sf, "pop_ase_mgra").where("increment = 2028")
    return quality.not_in_controls(standin(spark, sf, X), one_year)


@query(
    "q10_crosswalk_validity",
    f"""{ctes(X)} select mgra, PUMA, region from geo_cross_walk
    where not (PUMA between 7301 and 7322 and mgra between 1 and 30000 and region = 1)""",
)
def _(spark, sf):
    return quality.invalid_crosswalk(standin(spark, sf, X))


JOBS = " + ".join(f"coalesce({l}, 0)" for l in ECONOMIC_LABELS if l.startswith("job_"))
LFP = " + ".join(f"coalesce({l}, 0)" for l in ECONOMIC_LABELS if l.startswith("lfp_"))
PIVOT = ", ".join(f"sum(case when Label = '{l}' then value end) as {l}" for l in ECONOMIC_LABELS)


@query(
    "q11_employment",
    f"""{ctes(ECON)}, {LONG}, p as (select region, year, {PIVOT} from long group by region, year),
    s as (select region, year, job_2 - 2000 as job_2, {JOBS} - 2000 as jobs, {LFP} as labor_force from p)
    select region, year, cast(job_2 as double) as job_2, cast(jobs as double) as jobs,
      cast(labor_force as double) as labor_force from s where job_2 < 0 or labor_force < jobs""",
)
def _(spark, sf):
    rows = controls.economic_controls(standin(spark, sf, ECON), YEARS)
    found = quality.employment_gap(rows.withColumn("job_2", F.col("job_2") - 2000))
    return as_doubles(found, ["job_2", "jobs", "labor_force"])


@query(
    "q12_growth",
    f"""{ctes(ECON)}, {LONG}, t as (select region, Label, year, cast(sum(value) as double) as value from long
      group by region, Label, year),
    g as (select *, lag(value) over (partition by region, Label order by year) as before from t)
    select region, Label, year, value, round(case when before <> 0 then (value - before) / before end, 6) as growth from g
    where (value - before) / before <= -0.1 or (value - before) / before >= 0.2""",
)
def _(spark, sf):
    totals = (
        controls.economic_long(standin(spark, sf, ECON), YEARS)
        .groupBy("region", "Label", "year")
        .agg(F.sum("value").cast("double").alias("value"))
    )
    found = quality.growth_outliers(totals, ["region", "Label"], "year", "value")
    return found.withColumn("growth", F.round("growth", 6))


@query(
    "q13_income",
    f"""{ctes(H, P)}, {SEED_HH}, a as (select count(*) filter (where not HHADJINC between 0 and 9999999) as out_of_range,
      avg(HHADJINC) filter (where HINCP is not null) / avg(HINCP) filter (where HHADJINC is not null) as ratio from seed_hh)
    select out_of_range, round(ratio, 6) as ratio, ratio between 1.07 and 1.22 as plausible from a""",
)
def _(spark, sf):
    return quality.income_check(seed_hh(spark, sf)).withColumn("ratio", F.round("ratio", 6))


@query(
    "q14_workers",
    f"""{ctes(H, P)}, {SEED_HH} select SERIALNO, NP - 1 as NP, workers from seed_hh
    where workers < 0 or workers > NP - 1""",
)
def _(spark, sf):
    rows = seed_hh(spark, sf).select("SERIALNO", (F.col("NP") - 1).alias("NP"), "workers")
    return quality.impossible_workers(rows)


@query(
    "q15_codes",
    f"""{ctes(H, P)}, {SEED_PP} select race, NAICS2, count(*) as n from seed_pp
    where race is null or race not in ('Asian alone', 'Black or African American alone', 'Hispanic', 'Other',
      'Two or More Races', 'White alone')
    or not (NAICS2 is null or NAICS2 = 'MIL' or length(NAICS2) = 2 or NAICS2 in ('721', '722')) group by race, NAICS2""",
)
def _(spark, sf):
    return quality.invalid_codes(seed_pp(spark, sf))


@query(
    "q16_merged_population",
    f"""{ctes(SH)}, m as (select household_id - household_id % 2 * (mgra % 2) as household_id, synthesis_run, gq_type
      from synthetic_households), d as (select household_id, count(*) as c from m group by household_id)
    select synthesis_run, count(*) as records, count(*) filter (where c > 1) as repeated_ids,
      count(*) filter (where gq_type <> case synthesis_run when 'gq_mil' then 1 when 'gq_col' then 2 when 'gq_oth' then 3
        else 0 end) as wrong_type from m join d using (household_id) group by synthesis_run""",
)
def _(spark, sf):
    clash = F.expr("household_id - household_id % 2 * (mgra % 2)")
    rows = standin(spark, sf, SH).select(clash.alias("household_id"), "synthesis_run", "gq_type")
    return quality.merged_population_check(rows)


SIZES = ["HHSize_1", "HHSize_2", "HHSize_3", "HHSize_4Plus"]


@query(
    "q17_parts_per_puma",
    f"""{ctes(SP)}, c as (select id, Total_HH_control, {', '.join(f'{s}_control' for s in SIZES)} from summary_puma)
    select *, Total_HH_control - ({' + '.join(f'{s}_control' for s in SIZES)}) as gap from c
    where Total_HH_control - ({' + '.join(f'{s}_control' for s in SIZES)}) <> 0""",
)
def _(spark, sf):
    parts = [f"{s}_control" for s in SIZES]
    return quality.parts_gap(standin(spark, sf, SP).select("id", "Total_HH_control", *parts), "Total_HH_control", parts)


@query(
    "q18_levels",
    f"""{ctes(SM)}, {MELT}, z as (select target, sum(control_value) as zone_total from melted group by target),
    r as (select target, sum(result) as region_total from melted group by target)
    select target, zone_total, region_total, zone_total - region_total as gap from z join r using (target)
    where zone_total <> region_total""",
)
def _(spark, sf):
    rows = reshape.melt_summary(standin(spark, sf, SM))
    zone_totals = rows.groupBy("target").agg(F.sum("control_value").alias("zone_total"))
    region_totals = rows.groupBy("target").agg(F.sum("result").alias("region_total"))
    return quality.level_gap(zone_totals, region_totals, ["target"])


@query(
    "q19_type_drift",
    f"""{ctes(P)}, c as (select RAC1P, count(*) filter (where NAICSP is not null and try_cast(NAICSP as int) is null) as NAICSP,
      count(*) filter (where SOCP is not null and try_cast(SOCP as int) is null) as SOCP from person_src group by RAC1P)
    select RAC1P, "column", failures from (unpivot c on NAICSP, SOCP into name "column" value failures)""",
)
def _(spark, sf):
    return quality.type_drift(persons(spark, sf), {"NAICSP": "int", "SOCP": "int"}, ["RAC1P"])


@query(
    "u05_set_difference",
    f"""{ctes('pop_ase_mgra', 'mgrabase')} select mgra, increment from mgrabase
    except select mgra, increment from pop_ase_mgra""",
)
def _(spark, sf):
    keys = lambda name: standin(spark, sf, name).select("mgra", "increment")
    return quality.run_differences(keys("mgrabase"), keys("pop_ase_mgra"))
