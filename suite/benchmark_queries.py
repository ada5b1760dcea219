"""Benchmarks of households and persons, each at its own geography."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.incidence_queries import REPORTING, duck
from suite.registry import query
from suite.report_queries import BENCH_CONTROLS, bench_controls
from suite.seed_queries import LABOR_SQL, RACE_SQL, P
from suite.standins import ctes, standin
from suite.synthesis_queries import SH, X
from zonecraft.definitions import Control
from zonecraft.operators import reporting

MINE = [
    Control("Minors", "mgra", "persons", None, "AGEP <= 17", population="persons"),
    Control("Asian_Pop", "PUMA", "persons", None, "race = 'Asian alone'", "Asian", "persons"),
    Control("Puma_Large", "PUMA", "households", None, "NP >= 4", population="households"),
    Control("Labor_Force", "region", "persons", None, "laborforce = 1", "job_all", "persons"),
    Control("Vehicles_0", "region", "households", None, "VEH = 0", population="households"),
    Control("Reported", "region", "households", None, "VEH = 1", population="households"),
]
EVERY = REPORTING + MINE
SOURCES = ("hh_characteristics_mgra", SH, X, P)

_POP = f"""people as (select p.*, h.mgra, h.gq_type, {RACE_SQL} as race, {LABOR_SQL} as laborforce from person_src p
    join synthetic_households h on h.household_id = p.household_id where h.gq_type = 0),
  homes as (select * from synthetic_households where gq_type = 0)"""


def _counted(control) -> str:
    source = "people" if control.population == "persons" else "homes"
    area, join = {"mgra": ("mgra", ""), "PUMA": ("x.PUMA", " join geo_cross_walk x using (mgra)"), "region": ("1", "")}[control.geography]
    return f"""select '{control.target}' as target, '{control.geography}' as geography, cast({area} as bigint) as id,
      count(*) filter (where {duck(control)}) as result from {source}{join} group by {area}"""


COUNTS = f"counts as ({' union all '.join(_counted(c) for c in EVERY if c.target != 'Reported')})"
# Totals exist for zones above a size, for PUMAs with an even number, and for one of the region's benchmarks.
TARGETS = """goals as (select * from (unpivot (select mgra as id, 'mgra' as geography, HHChild_0, HHChild_1Plus,
    HHChild_0 + 5 as Minors from bench) on HHChild_0, HHChild_1Plus, Minors into name target value control_value)
  union all select distinct PUMA as id, 'PUMA' as geography, 'Asian_Pop' as target, PUMA * 2 as control_value
    from geo_cross_walk where PUMA % 2 = 0
  union all select 1, 'region', 'Labor_Force', 1234)"""


def compared(spark, sf):
    zones = bench_controls(spark, sf).withColumn("Minors", F.col("HHChild_0") + 5)
    crosswalk = standin(spark, sf, X)
    pumas = crosswalk.select("PUMA").distinct().where("PUMA % 2 = 0").withColumn("Asian", (F.col("PUMA") * 2).cast("long"))
    region = spark.createDataFrame([(1, 1234)], "region int, job_all long")
    ids = spark.createDataFrame([(n, c.target, c.field) for n, c in enumerate(EVERY, 1)], "control_id long, target string, control_field string")
    reported = spark.createDataFrame([("Reported",), ("HHChild_0",)], "target string")
    households, persons = standin(spark, sf, SH), standin(spark, sf, P)
    return reporting.benchmark_comparisons(EVERY, ids, zones, households, persons, crosswalk, reported, region, pumas)


@query(
    "a06_all_benchmarks",
    f"{ctes(*SOURCES)}, {_POP}, {COUNTS} select target, geography, id, result from counts",
)
def _(spark, sf):
    households, persons = standin(spark, sf, SH), standin(spark, sf, P)
    zone_of = households.select("household_id", "mgra")
    members = reporting.person_population(persons, households).join(zone_of, "household_id")
    populations = {"households": reporting.household_population(households), "persons": members}
    chosen = [c for c in EVERY if c.target != "Reported"]
    return reporting.benchmark_counts(populations, chosen, standin(spark, sf, X))


ALIGNED = f"""aligned as (select coalesce(g.target, c.target) as target, coalesce(g.geography, c.geography) as geography,
    coalesce(g.id, c.id) as id, cast(control_value as bigint) as control_value, coalesce(result, 0) as result
    from goals g full join counts c on c.target = g.target and c.geography = g.geography and c.id = g.id),
  fields as (select * from (values {', '.join(f"({n}, '{c.target}', '{c.field}')" for n, c in enumerate(EVERY, 1))})
    f(control_id, target, control_field)),
  numbered as (select control_id, a.target, control_field, geography, id, control_value, result, 'Benchmark Only' as "Status"
    from aligned a join fields f on f.target = a.target)"""


@query(
    "j11_all_benchmarks",
    f"{ctes(*SOURCES)}, {BENCH_CONTROLS}, {_POP}, {COUNTS}, {TARGETS}, {ALIGNED} select * from numbered",
)
def _(spark, sf):
    own = spark.createDataFrame([(c.target, c.geography) for c in EVERY], "target string, geography string")
    return compared(spark, sf).join(own, ["target", "geography"], "left_semi")


@query(
    "u03_all_benchmarks",
    f"""{ctes(*SOURCES)}, {BENCH_CONTROLS}, {_POP}, {COUNTS}, {TARGETS}, {ALIGNED} select * from numbered
    union all select control_id, target, control_field, 'region', 1, cast(sum(control_value) as bigint),
      cast(sum(result) as bigint), "Status" from numbered where geography = 'mgra' and target <> 'HHChild_0'
      group by control_id, target, control_field, "Status"
    union all select control_id, target, control_field, 'PUMA', PUMA, cast(sum(control_value) as bigint),
      cast(sum(result) as bigint), "Status" from numbered join geo_cross_walk on mgra = id where geography = 'mgra'
      group by control_id, target, control_field, "Status", PUMA""",
)
def _(spark, sf):
    return compared(spark, sf)
