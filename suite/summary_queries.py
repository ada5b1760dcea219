"""Summaries of an expanded population against its controls."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.incidence_queries import FITTING, INCIDENCE, count_sql, incidence_rows, synthetic_persons
from suite.registry import query
from suite.seed_queries import RACE_SQL, H, P
from suite.standins import ctes, standin
from zonecraft.functions import seed as fn
from zonecraft.operators import summaries

SH = "synthetic_households"
SM = "summary_mgra"
CHOSEN = ["Total_HH", "HHSize_1", "HHSize_2", "HHSize_3", "HHSize_4Plus", "HHWork_0", "HHWork_1", "Male", "Total_Pop", "Asian"]
CONTROLS = [c for c in FITTING if c.target in CHOSEN]
HH = [c for c in CONTROLS if c.seed_table == "households"]
PP = [c for c in CONTROLS if c.seed_table == "persons"]
TARGETS = [c.target for c in CONTROLS]

RESULTS = f"""hr as (select mgra, {count_sql(HH)} from synthetic_households group by mgra),
  pr as (select mgra, {count_sql(PP)} from (select p.*, s.mgra, {RACE_SQL} as race from person_src p
    join synthetic_households s on s.household_id = p.household_id) q group by mgra),
  zone_rows as (select id as mgra, {', '.join(f'{t}_control, coalesce({t}, 0) as {t}_result' for t in TARGETS)}
    from summary_mgra left join hr on hr.mgra = id left join pr on pr.mgra = id)"""


def zone_rows(spark, sf):
    persons = synthetic_persons(spark, sf).withColumn("race", fn.race(F.col("HISP"), F.col("RAC1P")))
    controls = standin(spark, sf, SM).select(F.col("id").alias("mgra"), *[F.col(f"{t}_control").alias(t) for t in TARGETS])
    return summaries.zone_summary(standin(spark, sf, SH), persons, controls, CONTROLS, ["mgra"])


@query(
    "y11_zone_summary",
    f"""{ctes(SH, P, SM)}, {RESULTS} select mgra as id, 'mgra' as geography,
    {', '.join(f'{t}_control, {t}_result, {t}_result - {t}_control as {t}_diff' for t in TARGETS)} from zone_rows""",
)
def _(spark, sf):
    return summaries.as_geography(zone_rows(spark, sf), "mgra", TARGETS)


@query(
    "y11_puma_summary",
    f"""{ctes(SH, P, SM, 'geo_cross_walk')}, {RESULTS} select PUMA as id, 'PUMA' as geography, {', '.join(
        f'cast(sum({t}_control) as bigint) as {t}_control, cast(sum({t}_result) as bigint) as {t}_result, '
        f'cast(sum({t}_result) - sum({t}_control) as bigint) as {t}_diff' for t in TARGETS)}
    from zone_rows join geo_cross_walk using (mgra) group by PUMA""",
)
def _(spark, sf):
    rolled = summaries.roll_up(zone_rows(spark, sf), standin(spark, sf, "geo_cross_walk"), TARGETS)
    return summaries.as_geography(rolled, "PUMA", TARGETS)


EVERY = [c.target for c in FITTING]
STAGES = {
    "region_preliminary_balanced_weight": "WGTP * 1.25e0",
    "region_balanced_weight": "WGTP * 1.5e0",
    "region_integer_weight": "WGTP",
    "mgra_balanced_weight": "WGTP + 0.5e0",
    "mgra_integer_weight": "1 + WGTP % 3",
}


@query(
    "y12_region_summary",
    f"""{ctes(H, P)}, {INCIDENCE}, s as ({' union all '.join(
        f"select '{t}' as control_name, cast(sum(2 * WGTP * {t}) as bigint) as control_value, "
        + ", ".join(f"round(cast(sum(({e}) * {t}) as double), 4) as {n}" for n, e in STAGES.items())
        + " from inc_rows" for t in EVERY)}) select * from s""",
)
def _(spark, sf):
    rows = incidence_rows(spark, sf).withColumns({n: F.expr(e) for n, e in STAGES.items()})
    totals = rows.agg(*[F.sum(2 * F.col("WGTP") * F.col(t)).alias(t) for t in EVERY])
    controls = totals.unpivot([], EVERY, "control_name", "control_value")
    summary = summaries.region_summary(rows, controls, EVERY, list(STAGES))
    return summary.withColumns({n: F.round(F.col(n).cast("double"), 4) for n in STAGES})
