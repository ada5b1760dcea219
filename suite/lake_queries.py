"""Published runs as files: their physical types, profiles that merge, and summaries of all controls."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.control_queries import FORECAST, ZONES, zones
from suite.incidence_queries import FITTING, count_sql, synthetic_persons
from suite.registry import query
from suite.seed_queries import RACE_SQL, P
from suite.standins import ctes, standin
from zonecraft.functions import seed as fn
from zonecraft.operators import quality, seed, summaries
from zonecraft.session import new_stage_path, stage
from zonecraft.sources import physical
from zonecraft.sources import publish as sinks

SH = "synthetic_households"
ZONE_CONTROLS = [c for c in FITTING if c.geography == "mgra"]
HH = [c for c in ZONE_CONTROLS if c.seed_table == "households"]
PP = [c for c in ZONE_CONTROLS if c.seed_table == "persons"]
TARGETS = [c.target for c in ZONE_CONTROLS]
SIDE = {c.target: "hr" if c.seed_table == "households" else "pr" for c in ZONE_CONTROLS}

ROWS = f"""hr as (select mgra, {count_sql(HH)} from synthetic_households group by mgra),
  pr as (select mgra, {count_sql(PP)} from (select p.*, s.mgra, {RACE_SQL} as race from person_src p
    join synthetic_households s on s.household_id = p.household_id) q group by mgra),
  zone_rows as (select z.mgra, {', '.join(f'z.{t} as {t}_control, coalesce({SIDE[t]}.{t}, 0) as {t}_result' for t in TARGETS)}
    from zones z left join hr on hr.mgra = z.mgra left join pr on pr.mgra = z.mgra where increment = 2022)"""


def zone_rows(spark, sf):
    persons = synthetic_persons(spark, sf).withColumn("race", fn.race(F.col("HISP"), F.col("RAC1P")))
    controls = zones(spark, sf).where("increment = 2022").select("mgra", *TARGETS)
    return summaries.zone_summary(standin(spark, sf, SH), persons, controls, ZONE_CONTROLS, ["mgra"])


@query(
    "y11_all_zone_controls",
    f"""{ctes(SH, P, *FORECAST)}, {ZONES}, {ROWS} select mgra as id, 'mgra' as geography,
    {', '.join(f'{t}_control, {t}_result, {t}_result - {t}_control as {t}_diff' for t in TARGETS)} from zone_rows""",
)
def _(spark, sf):
    return summaries.as_geography(zone_rows(spark, sf), "mgra", TARGETS)


@query(
    "y11_all_puma_controls",
    f"""{ctes(SH, P, 'geo_cross_walk', *FORECAST)}, {ZONES}, {ROWS} select PUMA as id, 'PUMA' as geography, {', '.join(
        f'cast(sum({t}_control) as bigint) as {t}_control, cast(sum({t}_result) as bigint) as {t}_result, '
        f'cast(sum({t}_result) - sum({t}_control) as bigint) as {t}_diff' for t in TARGETS)}
    from zone_rows join geo_cross_walk using (mgra) group by PUMA""",
)
def _(spark, sf):
    rolled = summaries.roll_up(zone_rows(spark, sf), standin(spark, sf, "geo_cross_walk"), TARGETS)
    return summaries.as_geography(rolled, "PUMA", TARGETS)


# --- physical types ----------------------------------------------------------------------------------------------

STAMP = "2026-01-02 03:04:05"


@query(
    "q19_schema_drift",
    f"""{ctes(SH)}, years as (select distinct year from synthetic_households)
    select year, 'HHADJINC' as "column", 'int64' as kind, 'double' as usual from years where year % 7 = 3
    union all select year, 'VEH', null, 'int32' from years where year % 7 = 5
    union all select year, 'gq_type', 'string', 'int32' from years where year % 7 = 5""",
)
def _(spark, sf):
    """All years' households as files, three columns of two years written in another type or left out."""
    root = new_stage_path(spark, "lake")
    income = F.col("HHADJINC").cast("double").alias("HHADJINC")
    households = stage(standin(spark, sf, SH).select("year", "household_id", income, "VEH", "gq_type"))
    for rest in range(7):
        own = households.where(F.col("year") % 7 == rest)
        if rest == 3:
            own = own.withColumn("HHADJINC", F.col("HHADJINC").cast("long"))
        if rest == 5:
            own = own.drop("VEH").withColumn("gq_type", F.col("gq_type").cast("string"))
        sinks.publish(sinks.with_run(own, F.col("year"), F.to_timestamp(F.lit(STAMP))), root, SH)
    found = quality.schema_drift(physical.published_schemas(spark, root, SH))
    return found.select("year", "column", "kind", "usual")


# --- profiles ----------------------------------------------------------------------------------------------------

PROFILED = ["PUMA", "NAICSP", "SERIALNO", "AGEP"]


def _profile_sql(distinct: str) -> str:
    return " union all ".join(
        f"""select '{c}' as "column", count(*) as rows, count(*) - count({c}) as nulls, {distinct.format(c=c)} from people"""
        for c in PROFILED
    )


PEOPLE = """people as (select p.NAICSP, p.SERIALNO, p.AGEP, x.PUMA from person_src p
  join synthetic_households h on h.household_id = p.household_id join geo_cross_walk x on x.mgra = h.mgra)"""


def people(spark, sf):
    places = standin(spark, sf, "geo_cross_walk").select("mgra", "PUMA")
    homes = standin(spark, sf, SH).select("household_id", "mgra").join(places, "mgra")
    return standin(spark, sf, P).drop("PUMA").join(homes.select("household_id", "PUMA"), "household_id")


_SOURCES = f"{ctes(P, SH, 'geo_cross_walk')}, {PEOPLE}"


@query("a20_distinct_profile", f"{_SOURCES} {_profile_sql('count(distinct {c}) as distinct_values')}")
def _(spark, sf):
    found = seed.distinct_profile(people(spark, sf), PROFILED)
    return found.withColumnRenamed("distinct", "distinct_values")


@query("a20_merged_profile", f"{_SOURCES} {_profile_sql('true as near')}")
def _(spark, sf):
    """Sketches of each PUMA, merged without the rows, against the exact numbers."""
    rows = people(spark, sf)
    stored = stage(seed.sketch_profile(rows.withColumn("_area", F.col("PUMA")), PROFILED, ["_area"]), "profiles")
    exact = seed.distinct_profile(rows, PROFILED).select("column", F.col("distinct").alias("exact"))
    near = F.abs(F.col("distinct") - F.col("exact")) <= 0.03 * F.col("exact")
    return seed.merged_profile(stored).join(exact, "column").select("column", "rows", "nulls", near.alias("near"))
