"""Definitions, comparison tables, report and accuracy measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.incidence_queries import REPORTING, count_sql
from suite.registry import query
from suite.seed_queries import LABOR_SQL, RACE_SQL, P
from suite.standins import SUMMARY_TARGETS, ctes, standin
from zonecraft.functions import report as fn
from zonecraft.functions import seed as seed_fn
from zonecraft.operators import metrics, reporting, reshape
from zonecraft.operators.keys import first_per_key
from zonecraft.sources import runs

SM, SP, X, SH, CT, DEF = (
    "summary_mgra",
    "summary_puma",
    "geo_cross_walk",
    "synthetic_households",
    "control_totals",
    "definitions",
)


def _melt_sql(source: str, name: str) -> str:
    rows = " union all ".join(
        f"select lower(geography) as geography, id, '{t}' as target, cast({t}_control as double) as control_value, cast({t}_result as double) as result "
        f"from {source}"
        for t in SUMMARY_TARGETS
    )
    return f"{name} as ({rows})"


MELT = _melt_sql(SM, "melted")
MELT_PUMA = _melt_sql(SP, "melted_puma")
DIFF_SQL = """result - control_value as "Diff", case when control_value is null or result is null then null
  when control_value = result then 0 when control_value = 0 then null
  else round(100.0e0 * (result - control_value) / control_value, 2) end as "Diff %\""""


def category_sql(field: str) -> str:
    """The local categories as SQL."""
    return f"""case when {field} is null then 'Uncategorized' when {field} = 'Total_HH' then 'Households'
    when starts_with({field}, 'HHSize_') then 'Household Size' when starts_with({field}, 'HHInc_') then 'Household Income'
    when starts_with({field}, 'HHWork_') then 'Household Workers'
    when starts_with({field}, 'HHChild_') then 'Household Children' when {field} in ('Male', 'Female') then 'Sex'
    when {field} = 'Total_Pop' then 'Household Population' when starts_with({field}, 'Age_') then 'Age'
    when {field} in ('Asian', 'Black', 'Hispanic', 'Other', 'Two_or_more', 'White') then 'Race/Ethnicity'
    when starts_with({field}, 'job_') then 'Labor Force' when starts_with({field}, 'lfp_') then 'Civilian Labor Force'
    when {field} = 'Total_GQ' or starts_with({field}, 'GQ_') then 'Group Quarters' end"""


def pattern_sql(field: str) -> str:
    """The database categories as SQL."""
    return f"""case when {field} = 'Total_HH' then 'Households' when {field} ilike 'HHSize_%' then 'Household Size'
    when {field} ilike 'HHInc_%' then 'Household Income' when {field} ilike 'HHWork__%' then 'Household Workers'
    when {field} ilike 'HHChild_%' then 'Household Children' when {field} in ('Male', 'Female') then 'Sex'
    when {field} ilike 'Age_%' then 'Age'
    when {field} in ('Asian', 'Black', 'Hispanic', 'Other', 'Two_or_more', 'White') then 'Race/Ethnicity'
    when {field} ilike 'job_%' then 'Labor Force' when {field} ilike 'lfp_%' then 'Civilian Labor Force'
    when {field} ilike 'gq__%' then 'Group Quarters' end"""


def melted(spark, sf):
    return reshape.melt_summary(standin(spark, sf, SM))


def with_category(rows):
    return rows.withColumn("Category", fn.category_local(F.col("target")))


# --- definitions -------------------------------------------------------------------------------------------------

# Every part is one line of some run's definition file; a run is a part size, a target a brand.
DEFINITION_LINES = """
select p_size as run, p_brand as target, p_type as control_field, cast(p_partkey as bigint) as ordinal,
  cast(p_partkey % 2 as int) as kind, cast(case when p_size % 3 = 0 then 1 else p_partkey % 4 % 2 end as int) as priority
from part"""
LINES = f"lines as ({DEFINITION_LINES})"
BEST = """best as (select * from lines l where priority =
  (select min(priority) from lines m where m.run = l.run and m.kind = l.kind))"""
FIRST = """firsts as (select * from (select *, row_number() over (partition by run, target order by kind, ordinal) as r
  from best) t where r = 1)"""


def definition_lines(spark, sf):
    from suite.standins import table

    return spark.sql(DEFINITION_LINES.replace("from part", "from {part}"), part=table(spark, sf, "part"))


@query(
    "s06_read_definitions",
    f"""with {LINES}, {BEST}, {FIRST} select run, target, control_field, kind, ordinal,
    row_number() over (partition by run order by kind, ordinal) as control_id from firsts""",
)
def _(spark, sf):
    return reporting.resolve_definitions(definition_lines(spark, sf)).drop("priority")


@query(
    "w02_number_definitions",
    f"""with {LINES} select run, target, kind, ordinal,
    row_number() over (partition by run order by kind, ordinal) as control_id from lines""",
)
def _(spark, sf):
    lines = definition_lines(spark, sf).select("run", "target", "kind", "ordinal")
    return reporting.number_definitions(lines, ["run"], ["kind", "ordinal"])


@query(
    "w04_keep_first",
    f"""with {LINES}, ranked as (select *, row_number() over (partition by target order by kind, ordinal) as r from lines)
    select target, control_field, kind, ordinal from ranked where r = 1""",
)
def _(spark, sf):
    lines = definition_lines(spark, sf).select("target", "control_field", "kind", "ordinal")
    return first_per_key(lines, ["target"], ["kind", "ordinal"])


@query(
    "u02_stack_definitions",
    f"""with {LINES} select run, target, control_field, ordinal, null::int as population from lines where kind = 0
    union all select run, target, null, ordinal, priority from lines where kind = 1""",
)
def _(spark, sf):
    lines = definition_lines(spark, sf)
    fitting = lines.where("kind = 0").select("run", "target", "control_field", "ordinal")
    extra = lines.where("kind = 1").select("run", "target", "ordinal", F.col("priority").alias("population"))
    return reporting.stack([fitting, extra])


@query(
    "o05_first_definition",
    f"""with {LINES} select run, arg_min(control_field, ordinal) as control_field from lines group by run""",
)
def _(spark, sf):
    return reporting.first_control_field(definition_lines(spark, sf), "run")


@query(
    "p24_select_benchmarks",
    f"""with {LINES}, tagged as (select *, case when kind = 1 then 'region' else 'mgra' end as geography,
      case when priority = 0 then 'households' end as population from lines)
    select run, target, geography, ordinal from tagged where population is not null
    and not (geography = 'region' and target in (select p_brand from part where p_size = 1))""",
)
def _(spark, sf):
    lines = definition_lines(spark, sf).withColumns(
        {
            "geography": F.when(F.col("kind") == 1, "region").otherwise("mgra"),
            "population": F.when(F.col("priority") == 0, "households"),
        }
    )
    reported = definition_lines(spark, sf).where("run = 1").select("target")
    return reporting.select_benchmarks(lines, reported).select("run", "target", "geography", "ordinal")


@query(
    "w06_gq_control_ids",
    f"""{ctes(SH, DEF)}, present as (select distinct synthesis_run from synthetic_households
      where synthesis_run in ('gq_col', 'gq_mil', 'gq_oth'))
    select synthesis_run, 57 + row_number() over (order by synthesis_run) as control_id from present""",
)
def _(spark, sf):
    return reporting.number_gq_runs(standin(spark, sf, SH), 57)


# --- melting and joining -----------------------------------------------------------------------------------------


@query("r01_melt_summary", f"{ctes(SM)}, {MELT} select * from melted")
def _(spark, sf):
    return melted(spark, sf)


@query("j07_join_melted", f"{ctes(SM)}, {MELT} select 'mgra' as geography, id, target, control_value, result from melted")
def _(spark, sf):
    summary = standin(spark, sf, SM)
    controls = reshape.melt_side(summary, "_control", "control_value")
    return reshape.join_melted(controls, reshape.melt_side(summary, "_result", "result"))


@query(
    "r02_widen",
    f"""{ctes(SM)} select id, {', '.join(
        f'cast({t}_control as double) as {t}_control, cast({t}_result as double) as {t}_result, '
        f'cast({t}_result - {t}_control as double) as {t}_diff' for t in SUMMARY_TARGETS)} from summary_mgra""",
)
def _(spark, sf):
    return reshape.widen(melted(spark, sf), ["id"], SUMMARY_TARGETS)


@query(
    "p29_lower_geography",
    f"{ctes(SP)}, {MELT_PUMA} select geography, count(*) as n from melted_puma group by geography",
)
def _(spark, sf):
    return reshape.melt_summary(standin(spark, sf, SP)).groupBy("geography").agg(F.count("*").alias("n"))


REGION = f"""region_rows as (select target as control_name, sum(control_value) as control_value,
  sum(result) as mgra_integer_weight from melted group by target)"""


def region_summary(spark, sf):
    return (
        melted(spark, sf)
        .groupBy(F.col("target").alias("control_name"))
        .agg(F.sum("control_value").alias("control_value"), F.sum("result").alias("mgra_integer_weight"))
    )


@query(
    "p26_region_constants",
    f"""{ctes(SM)}, {MELT}, {REGION} select 'region' as geography, 1 as id, control_name as target, control_value,
    mgra_integer_weight as result from region_rows""",
)
def _(spark, sf):
    return reshape.region_constants(region_summary(spark, sf))


@query(
    "j09_attach_definitions",
    f"""{ctes(SM, DEF)}, {MELT} select m.*, control_id, control_field from melted m
    left join definitions d on d.target = m.target""",
)
def _(spark, sf):
    return reporting.attach_definitions(melted(spark, sf), standin(spark, sf, DEF))


@query(
    "j10_map_and_drop",
    f"""{ctes(SM, DEF)}, {MELT} select m.*, control_id, control_field from melted m
    join definitions d on d.target = m.target""",
)
def _(spark, sf):
    return reporting.attach_definitions(melted(spark, sf), standin(spark, sf, DEF), "inner")


@query(
    "u04_stack_summaries",
    f"""{ctes(SM, SP)}, {MELT}, {MELT_PUMA}, {REGION} select geography, target, count(*) as n,
    sum(control_value) as control_value, sum(result) as result from (
      select geography, target, control_value, result from melted union all
      select geography, target, control_value, result from melted_puma union all
      select 'region', control_name, control_value, mgra_integer_weight from region_rows) a group by geography, target""",
)
def _(spark, sf):
    stacked = reporting.stack(
        [
            melted(spark, sf),
            reshape.melt_summary(standin(spark, sf, SP)),
            reshape.region_constants(region_summary(spark, sf)),
        ]
    )
    return stacked.groupBy("geography", "target").agg(
        F.count("*").alias("n"), F.sum("control_value").alias("control_value"), F.sum("result").alias("result")
    )


# --- population and benchmarks -----------------------------------------------------------------------------------


@query(
    "p08_race_on_outputs",
    f"""{ctes(P)} select HISP, RAC1P, {RACE_SQL} as race, count(*) as n from person_src
    group by HISP, RAC1P, {RACE_SQL}""",
)
def _(spark, sf):
    race = seed_fn.race_from_numbers(F.col("HISP"), F.col("RAC1P")).alias("race")
    return standin(spark, sf, P).groupBy("HISP", "RAC1P", race).agg(F.count("*").alias("n"))


@query(
    "p09_labor_force_on_outputs",
    f"{ctes(P)} select {LABOR_SQL} as laborforce, count(*) as n from person_src group by {LABOR_SQL}",
)
def _(spark, sf):
    flag = seed_fn.labor_force_from_numbers(F.col("ESR").cast("string")).alias("laborforce")
    return standin(spark, sf, P).groupBy(flag).agg(F.count("*").alias("n"))


@query(
    "j05_validated_left_join",
    f"""{ctes(P, SH)} select p.household_id, SPORDER, gq_type from person_src p
    left join synthetic_households h on h.household_id = p.household_id""",
)
def _(spark, sf):
    joined = reporting.persons_with_type(standin(spark, sf, P), standin(spark, sf, SH))
    return joined.select("household_id", "SPORDER", "gq_type")


@query(
    "p25_non_gq_population",
    f"""{ctes(P, SH)} select p.household_id, SPORDER, {RACE_SQL} as race, {LABOR_SQL} as laborforce from person_src p
    join synthetic_households h on h.household_id = p.household_id where gq_type = 0""",
)
def _(spark, sf):
    kept = reporting.person_population(standin(spark, sf, P), standin(spark, sf, SH))
    return kept.select("household_id", "SPORDER", "race", "laborforce")


# Benchmark controls exist for zones with an even number only, results for zones with regular households only.
BENCH_CONTROLS = """bench as (select mgra, cast(sum(hhwoc) as bigint) as HHChild_0, cast(sum(hhwc) as bigint) as HHChild_1Plus
  from hh_characteristics_mgra group by mgra having sum(hhwoc) > 1)"""
ALIGNED = f"""counted as (select mgra, {count_sql(REPORTING)} from synthetic_households where gq_type = 0 group by mgra),
  long_controls as (select * from (unpivot bench on HHChild_0, HHChild_1Plus into name target value control_value)),
  long_counts as (select * from (unpivot counted on HHChild_0, HHChild_1Plus into name target value result)),
  aligned as (select coalesce(c.target, r.target) as target, 'mgra' as geography, coalesce(c.mgra, r.mgra) as id,
    control_value, coalesce(result, 0) as result from long_controls c
    full join long_counts r on r.mgra = c.mgra and r.target = c.target),
  numbered as (select case target when 'HHChild_0' then 56 else 57 end as control_id, target, target as control_field,
    geography, id, control_value, result, 'Benchmark Only' as "Status" from aligned)"""
BENCH = ("hh_characteristics_mgra", SH, X)


def bench_controls(spark, sf):
    grouped = standin(spark, sf, "hh_characteristics_mgra").groupBy("mgra")
    return grouped.agg(F.sum("hhwoc").alias("HHChild_0"), F.sum("hhwc").alias("HHChild_1Plus")).where("HHChild_0 > 1")


def benchmark_ids(spark):
    return spark.createDataFrame(
        [(56, "HHChild_0", "HHChild_0"), (57, "HHChild_1Plus", "HHChild_1Plus")],
        "control_id long, target string, control_field string",
    )


def benchmarks(spark, sf):
    households = standin(spark, sf, SH)
    reported = standin(spark, sf, DEF).select("target").where("target = 'HHChild_0'")
    crosswalk = standin(spark, sf, X)
    controls = bench_controls(spark, sf)
    return reporting.benchmark_comparisons(REPORTING, benchmark_ids(spark), controls, households, None, crosswalk, reported)


REGION_SQL = """select control_id, target, control_field, 'region' as geography, 1 as id,
  cast(sum(control_value) as bigint) as control_value, cast(sum(result) as bigint) as result, "Status"
  from numbered where target not in (select target from definitions where target = 'HHChild_0')
  group by control_id, target, control_field, "Status\""""
PUMA_SQL = """select control_id, target, control_field, 'PUMA' as geography, PUMA as id,
  cast(sum(control_value) as bigint) as control_value, cast(sum(result) as bigint) as result, "Status"
  from numbered join geo_cross_walk on mgra = id group by control_id, target, control_field, "Status", PUMA"""


@query("j11_align_benchmarks", f"{ctes(*BENCH)}, {BENCH_CONTROLS}, {ALIGNED} select * from numbered")
def _(spark, sf):
    return benchmarks(spark, sf).where("geography = 'mgra'")


@query("a07_region_benchmark_total", f"{ctes(*BENCH, DEF)}, {BENCH_CONTROLS}, {ALIGNED} {REGION_SQL}")
def _(spark, sf):
    return benchmarks(spark, sf).where("geography = 'region'")


@query("a08_puma_rollup", f"{ctes(*BENCH)}, {BENCH_CONTROLS}, {ALIGNED} {PUMA_SQL}")
def _(spark, sf):
    return benchmarks(spark, sf).where("geography = 'PUMA'")


ALL_BENCH = f"""everything as (select * from numbered union all {REGION_SQL} union all {PUMA_SQL})"""


@query(
    "u03_stack_comparisons",
    f"{ctes(*BENCH, DEF)}, {BENCH_CONTROLS}, {ALIGNED}, {ALL_BENCH} select * from everything",
)
def _(spark, sf):
    return benchmarks(spark, sf)


@query(
    "p32_export_benchmarks",
    f"""{ctes(*BENCH, DEF)}, {BENCH_CONTROLS}, {ALIGNED}, {ALL_BENCH}
    select target, control_field, geography, id, control_value, result from everything""",
)
def _(spark, sf):
    return reporting.export_benchmarks(benchmarks(spark, sf))


# --- report tables -----------------------------------------------------------------------------------------------


@query("p27_diff", f"{ctes(CT)} select geography_id, control_value, result, result - control_value as diff from control_totals")
def _(spark, sf):
    rows = standin(spark, sf, CT)
    difference = fn.diff(F.col("control_value"), F.col("result")).alias("diff")
    return rows.select("geography_id", "control_value", "result", difference)


@query(
    "p28_diff_pct",
    f"""{ctes(CT)}, d as (select geography_id, control_value, result, {DIFF_SQL} from control_totals)
    select geography_id, control_value, result, "Diff %" as pct from d""",
)
def _(spark, sf):
    rows = standin(spark, sf, CT)
    pct = fn.diff_pct(F.col("control_value"), F.col("result")).alias("pct")
    return rows.select("geography_id", "control_value", "result", pct)


@query(
    "p20_category_sql",
    f"{ctes(SM)}, {MELT} select target, {pattern_sql('target')} as category, count(*) as n from melted group by target",
)
def _(spark, sf):
    rows = melted(spark, sf).groupBy("target").agg(F.count("*").alias("n"))
    return rows.select("target", fn.category_sql(F.col("target")).alias("category"), "n")


@query(
    "p21_category_local",
    f"{ctes(SM)}, {MELT} select target, {category_sql('target')} as category, count(*) as n from melted group by target",
)
def _(spark, sf):
    rows = melted(spark, sf).groupBy("target").agg(F.count("*").alias("n"))
    return rows.select("target", fn.category_local(F.col("target")).alias("category"), "n")


@query(
    "p31_status_tag",
    f"""{ctes(SM)}, {MELT} select "Status", count(*) as n from (select 'Fitting Control' as "Status" from melted
    union all select 'Benchmark Only' from melted where target = 'HHChild_0') t group by "Status\"""",
)
def _(spark, sf):
    rows = melted(spark, sf)
    fitting = rows.withColumn("Status", F.lit(fn.FITTING))
    extra = rows.where("target = 'HHChild_0'").withColumn("Status", F.lit(fn.BENCHMARK))
    return reporting.stack([fitting, extra]).groupBy("Status").agg(F.count("*").alias("n"))


TOTALS = """totals as (select c.control_id, d.control_field, c.geography, geography_id as id, "Status",
  cast(sum(control_value) as bigint) as control_value, cast(sum(result) as bigint) as result
  from control_totals c left join definitions d on d.control_id = c.control_id
  group by c.control_id, d.control_field, c.geography, geography_id, "Status")"""
REPORT = f"""report as (select control_id as id, {category_sql('control_field')} as "Category",
  control_field as "Control Field", geography, id as geography_id, control_value as "Control", result as "Result",
  {DIFF_SQL}, "Status" from totals)"""


def totals(spark, sf):
    """Totals of all runs together with their definitions."""
    fields = standin(spark, sf, DEF).select("control_id", "control_field")
    rows = standin(spark, sf, CT).withColumnRenamed("geography_id", "id")
    return rows.join(fields, "control_id", "left")


def report(spark, sf):
    return reporting.report_table(totals(spark, sf))


@query("a09_consolidate", f"{ctes(CT, DEF)}, {TOTALS} select * from totals")
def _(spark, sf):
    return reporting.consolidate(totals(spark, sf))


@query("p33_report_columns", f"{ctes(CT, DEF)}, {TOTALS}, {REPORT} select * from report")
def _(spark, sf):
    return report(spark, sf)


@query(
    "o03_report_order",
    f"""{ctes(CT, DEF)}, {TOTALS}, {REPORT} select * from report
    order by id, "Control Field", geography, geography_id""",
)
def _(spark, sf):
    return reporting.report_order(report(spark, sf))


@query(
    "p30_tab_filter",
    f"""{ctes(CT, DEF)}, {TOTALS}, {REPORT} select * from report
    where geography = 'mgra' and "Category" = 'Household Size'""",
)
def _(spark, sf):
    return reporting.filter_report(report(spark, sf), "mgra", "Household Size")


RUN_DEFS = """run_defs as (select run_id, d.control_id, control_field from definitions d
  join (select distinct run_id, control_id from control_totals) r on r.control_id = d.control_id)"""


def run_definitions(spark, sf):
    used = standin(spark, sf, CT).select("run_id", "control_id").distinct()
    return standin(spark, sf, DEF).join(used, "control_id")


@query(
    "j08_totals_with_definitions",
    f"""{ctes(CT, DEF)}, {RUN_DEFS} select c.run_id, c.control_id, geography_id, control_value, result, control_field
    from control_totals c left join run_defs d on d.run_id = c.run_id and d.control_id = c.control_id""",
)
def _(spark, sf):
    fields = run_definitions(spark, sf).select("run_id", "control_id", "control_field")
    rows = standin(spark, sf, CT).join(fields, ["run_id", "control_id"], "left")
    return rows.select("run_id", "control_id", "geography_id", "control_value", "result", "control_field")


@query(
    "a10_run_report",
    f"""{ctes(CT, DEF)}, {RUN_DEFS}, g as (select d.control_id as id, control_field as "Control Field", c.geography,
      geography_id, cast(sum(control_value) as bigint) as "Control", cast(sum(result) as bigint) as "Result"
      from control_totals c left join run_defs d on d.run_id = c.run_id and d.control_id = c.control_id
      where c.run_id = 1998 group by 1, 2, 3, 4)
    select id, {pattern_sql('"Control Field"')} as "Category", "Control Field", geography, geography_id, "Control", "Result",
      "Result" - "Control" as "Diff", case when "Result" = "Control" then 0 when "Control" = 0 then null
      else round(100.0e0 * ("Result" - "Control") / "Control", 2) end as "Diff %" from g""",
)
def _(spark, sf):
    return reporting.run_report(standin(spark, sf, CT), run_definitions(spark, sf), 1998)


def _summary_sql(key: str, block: int) -> str:
    r = lambda e: f"round_even(({e}) * 100, 0) / 100"
    return f"""select {block} as block, min(id) as id, {key} as "Control Field", {r('avg("Diff")')} as "Avg Diff",
      {r('median("Diff")')} as "Med Diff", {r('avg("Diff %")')} as "Avg Diff %", {r('median("Diff %")')} as "Med Diff %",
      {r('max(abs("Diff"))')} as "Max |Diff|", {r('max(abs("Diff %"))')} as "Max |Diff %|"
      from report where {key} is not null group by {key}"""


@query(
    "a11_summarize_controls",
    f"""{ctes(CT, DEF)}, {TOTALS}, {REPORT} {_summary_sql('"Control Field"', 0)}
    union all {_summary_sql('"Category"', 1)} order by block, id""",
)
def _(spark, sf):
    return reporting.summarize_controls(report(spark, sf))


# --- accuracy ----------------------------------------------------------------------------------------------------

BOTH = f"{ctes(SM, SP)}, {MELT}, {MELT_PUMA}, long as (select * from melted union all select * from melted_puma)"


def both(spark, sf):
    return reporting.stack([melted(spark, sf), reshape.melt_summary(standin(spark, sf, SP))])


@query(
    "a13_household_accuracy",
    f"""{BOTH}, d as (select geography, abs(result - control_value) as s from long where target = 'Total_HH')
    select geography, count(*) as areas, count(*) filter (where s = 0) as exact, count(*) filter (where s <= 1) as within_1,
      count(*) filter (where s <= 2) as within_2, round(100.0e0 * count(*) filter (where s = 0) / count(*), 4) as pct_exact,
      round(100.0e0 * count(*) filter (where s <= 1) / count(*), 4) as pct_within_1,
      round(100.0e0 * count(*) filter (where s <= 2) / count(*), 4) as pct_within_2, max(s) as worst,
      case when max(s - case geography when 'region' then 50 when 'puma' then 25 when 'mgra' then 2 else 0 end) <= 0
        then 'acceptable' else 'review' end as grade from d group by geography""",
)
def _(spark, sf):
    measured = metrics.household_accuracy(both(spark, sf))
    return measured.withColumns({c: F.round(c, 4) for c in measured.columns if c.startswith("pct_")})


@query(
    "a14_error_by_control",
    f"""{BOTH}, e as (select target, {category_sql('target')} as "Category", geography, avg(abs(result - control_value)) as mae,
      avg(case when control_value > 0 then 100.0e0 * abs(result - control_value) / control_value end) as mape
      from long group by target, geography)
    select target, "Category", geography, round(mae, 4) as mae, round(mape, 4) as mape, case "Category"
      when 'Sex' then mae <= 3 and mape <= 3 when 'Age' then mae <= 5 and mape <= 5
      when 'Race/Ethnicity' then mae <= 4 and mape <= 8 when 'Household Size' then mae <= 2 and mape <= 10
      when 'Household Income' then mae <= 3 and mape <= 12 end as acceptable from e""",
)
def _(spark, sf):
    errors = metrics.error_by_target(with_category(both(spark, sf)), ("target", "Category", "geography"))
    graded = metrics.grade_errors(errors)
    return graded.withColumns({"mae": F.round("mae", 4), "mape": F.round("mape", 4)})


@query(
    "a15_employment_accuracy",
    f"""{BOTH}, e as (select geography, max(abs(result - control_value)) as max_diff,
      max(case when control_value > 0 then 100.0e0 * abs(result - control_value) / control_value end) as max_pct,
      sum(abs(result - control_value)) as total_diff from long where starts_with(target, 'job_') group by geography)
    select geography, max_diff, round(max_pct, 4) as max_pct, total_diff,
      case when max_diff <= 20 and max_pct <= 0.5 and total_diff <= 100 then 'acceptable' else 'review' end as grade from e""",
)
def _(spark, sf):
    return metrics.employment_accuracy(both(spark, sf)).withColumn("max_pct", F.round("max_pct", 4))


@query(
    "a16_gq_exact_rate",
    f"""{ctes(SM)}, {MELT} select target, count(*) filter (where control_value = result) as exact, count(*) as areas,
    round(100.0e0 * count(*) filter (where control_value = result) / count(*), 4) as pct_exact,
    case when count(*) filter (where control_value = result) = count(*) then 'ok' else 'critical' end as status
    from melted where starts_with(target, 'GQ_') group by target""",
)
def _(spark, sf):
    return metrics.exact_match_rate(melted(spark, sf)).withColumn("pct_exact", F.round("pct_exact", 4))


@query(
    "a19_puma_deviation",
    f"""{ctes(SP)}, {MELT_PUMA} select target, sum(control_value) as control, sum(result) as result,
    sum(result) - sum(control_value) as diff, case when sum(control_value) <> 0 then
      round(100.0e0 * (sum(result) - sum(control_value)) / sum(control_value), 4) end as pct
    from melted_puma group by target""",
)
def _(spark, sf):
    rows = metrics.deviation_by_target(reshape.melt_summary(standin(spark, sf, SP)))
    return rows.withColumn("pct", F.round("pct", 4))


@query(
    "o04_worst_areas",
    f"""{BOTH} select geography, id, abs(result - control_value) as abs_diff, result from long where target = 'Total_HH'
    order by abs_diff desc, geography, id limit 10""",
)
def _(spark, sf):
    return metrics.worst_areas(both(spark, sf), "Total_HH", 10).select("geography", "id", "abs_diff", "result")


@query(
    "o04_slowest_steps",
    f"""{ctes('step_log')}, r as (select *, row_number() over (partition by run_id order by seconds desc, event_id) as rank
    from step_log) select run_id, model_name, event_id, cast(seconds as double) as seconds, rank from r where rank <= 3""",
)
def _(spark, sf):
    rows = metrics.largest_per(standin(spark, sf, "step_log"), ["run_id"], "seconds", "event_id", 3)
    return rows.withColumn("seconds", F.col("seconds").cast("double"))


@query(
    "a17_run_timing",
    f"""{ctes('step_log')} select run_id, cast(sum(seconds) as double) as total_seconds,
    round(avg(cast(seconds as double)) filter (where contains(model_name, 'balancing')), 8) as mean_balancing
    from step_log group by run_id""",
)
def _(spark, sf):
    steps = standin(spark, sf, "step_log")
    return metrics.run_timing(steps).withColumns(
        {"total_seconds": F.col("total_seconds").cast("double"), "mean_balancing": F.round("mean_balancing", 8)}
    )


# --- runs --------------------------------------------------------------------------------------------------------

RUN_TABLES = ("view", "click")
CATALOG_SQL = f"""{ctes('run_log')}, c as (select run, max(ts) filter (where table_name = 'view') as a,
  max(ts) filter (where table_name = 'click') as b from run_log group by run), listed as (
  select run || '_local' as run_id, run as folder, case when regexp_matches(run, '^[0-9]{{4}}') then left(run, 4) else run end
    as year, strftime(a, '%Y-%m-%d %H:%M') as date, 'local' as version, 'local' as source
  from c where a is not null and b is not null)"""


@query("s07_run_catalog", f"{CATALOG_SQL} select * from listed")
def _(spark, sf):
    return runs.run_catalog(standin(spark, sf, "run_log"), RUN_TABLES)


@query("o06_latest_first", f"{CATALOG_SQL} select * from listed order by date desc, run_id desc")
def _(spark, sf):
    return runs.latest_first(runs.run_catalog(standin(spark, sf, "run_log"), RUN_TABLES))


STATUS_SQL = f"""{ctes('run_log')}, status as (select run_id,
  arg_max(table_name in ('purchase', 'signup'), (ts, event_id)) as loaded from run_log group by run_id)"""


def status(spark, sf):
    events = standin(spark, sf, "run_log")
    return runs.latest_status(events.withColumn("loaded", F.col("table_name").isin("purchase", "signup")))


@query("k10_status_flip", f"{STATUS_SQL} select run_id, loaded from status")
def _(spark, sf):
    return status(spark, sf)


@query("s08_loaded_runs", f"{STATUS_SQL} select run_id from status where loaded")
def _(spark, sf):
    return runs.loaded_runs(status(spark, sf)).select("run_id")


MARKERS_SQL = "select distinct run_id from run_log where table_name = 'signup'"


@query(
    "s09_read_completed",
    f"""{ctes('run_log')} select event_id, run_id as run_timestamp, cast(year(ts) as int) as year, value from run_log
    where run_id in ({MARKERS_SQL})""",
)
def _(spark, sf):
    rows = standin(spark, sf, "run_log").select(
        "event_id", F.col("run_id").alias("run_timestamp"), F.year("ts").alias("year"), "value", "table_name"
    )
    return runs.read_completed(rows, rows.where("table_name = 'signup'")).drop("table_name")


@query("a12_next_run_id", f"{ctes('run_log')} select coalesce(max(run_id) + 1, 1) as next_run_id from run_log")
def _(spark, sf):
    return metrics.next_run_id(standin(spark, sf, "run_log"))
