"""Sinks, markers, cleaned text and streaming pick-up."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.control_queries import FORECAST, ZONES, zones
from suite.registry import query
from suite.report_queries import DEFINITION_LINES, definition_lines
from suite.seed_queries import SEED_PP, H, P, seed_pp
from suite.standins import ctes, standin, table
from zonecraft.functions import report as fn
from zonecraft.plans.publication import publish_run
from zonecraft.schemas import schema
from zonecraft.session import new_stage_path
from zonecraft.sources import publish as sinks
from zonecraft.sources import tables
from zonecraft.streaming.ingest import ingest_completed

SH = "synthetic_households"


def _stamp(text):
    return F.to_timestamp(F.lit(text))


LAKE_ROWS = ["household_id", "mgra", "gq_type", "HHADJINC"]


def _published_years(spark, sf):
    """Every year's households published under one job time, and then once more with other rows, which must change nothing."""
    root = new_stage_path(spark, "lake")
    households = standin(spark, sf, SH)
    years = [r.year for r in households.select("year").distinct().orderBy("year").collect()]
    config = {"version": "v1", "years": years}
    for change in (False, True):
        rows = households.withColumn("mgra", F.lit(-1).cast("bigint")) if change else households
        for year in years:
            own = rows.where(F.col("year") == year).select(*LAKE_ROWS)
            publish_run(spark, {SH: own}, root, year, "2026-01-02 03:04:05", config, "20260102_030405", "tester")
    return root


@query(
    "k01_publish",
    f"""{ctes(SH)} select household_id, mgra, gq_type, HHADJINC, year, timestamp '2026-01-02 03:04:05' as run_timestamp
    from synthetic_households""",
)
def _(spark, sf):
    return spark.read.parquet(f"{_published_years(spark, sf)}/{SH}")


@query(
    "k02_publish_controls",
    f"""with lines as ({DEFINITION_LINES}) select target, control_field, ordinal, run,
    case when kind = 0 then 'household' else 'gq_mil' end as synthesis_run, 2022 as year,
    timestamp '2026-01-02 03:04:05' as run_timestamp from lines""",
)
def _(spark, sf):
    lines = definition_lines(spark, sf)
    columns = ["target", "control_field", "ordinal", "run"]
    household = sinks.controls_table(lines.where("kind = 0").select(*columns), "household")
    military = sinks.controls_table(lines.where("kind = 1").select(*columns), "gq_mil")
    rows = sinks.with_run(household.unionByName(military), 2022, _stamp("2026-01-02 03:04:05"))
    path = sinks.publish(rows, new_stage_path(spark, "lake"), "controls", ("year", "synthesis_run"))
    return spark.read.schema(rows.schema).parquet(path)


@query(
    "k03_publish_seed",
    f"""{ctes(H, P)}, {SEED_PP} select SERIALNO, SPORDER, NAICSP, NAICS2, SOCP, 'household' as synthesis_run, 2022 as year,
    timestamp '2026-01-02 03:04:05' as run_timestamp from seed_pp""",
)
def _(spark, sf):
    seed = seed_pp(spark, sf).select("SERIALNO", "SPORDER", "NAICSP", "NAICS2", "SOCP")
    rows = sinks.with_run(sinks.seed_table(seed, "household"), 2022, _stamp("2026-01-02 03:04:05"))
    path = sinks.publish(rows, new_stage_path(spark, "lake"), "seed_persons")
    return spark.read.schema(rows.schema).parquet(path)


@query(
    "k05_mark_complete",
    f"""{ctes(SH)} select year, 2 as succeeded, 'run_metadata,synthetic_households' as files, count(*) as household_rows,
    cast(1 as bigint) as metadata_rows from synthetic_households group by year""",
)
def _(spark, sf):
    markers = spark.read.schema(sinks.MARKER_SCHEMA).parquet(f"{_published_years(spark, sf)}/{sinks.MARKERS}")
    return markers.select(
        "year",
        "succeeded",
        F.array_join("files", ",").alias("files"),
        F.col("rows")[SH].alias("household_rows"),
        F.col("rows")["run_metadata"].alias("metadata_rows"),
    )


@query(
    "k04_run_metadata",
    f"""{ctes(SH)}, years as (select distinct year from synthetic_households) select year, '20260102_030405' as batch_id,
    'tester' as "user", 'v1' as version, (select '[' || string_agg(cast(year as varchar), ', ' order by year) || ']' from years)
    as years, timestamp '2026-01-02 03:04:05' as run_timestamp from years""",
)
def _(spark, sf):
    return spark.read.parquet(f"{_published_years(spark, sf)}/run_metadata")


@query(
    "k06_idempotent_publish",
    f"""{ctes(SH)} select year, count(*) as n, cast(sum(household_id) as bigint) as ids, cast(sum(mgra) as bigint) as zones from synthetic_households group by year""",
)
def _(spark, sf):
    lake = spark.read.parquet(f"{_published_years(spark, sf)}/{SH}")
    return lake.groupBy("year").agg(F.count("*").alias("n"), F.sum("household_id").alias("ids"), F.sum("mgra").alias("zones"))


@query(
    "k07_lake_name",
    f"""{ctes(SH)} select case when year % 2 = 0 then 'mgra15_based_input' else 'synthetic_persons_' || cast(year as varchar)
    end as name, count(*) as n from synthetic_households group by 1""",
)
def _(spark, sf):
    year = F.col("year").cast("string")
    prefix = F.when(F.col("year") % 2 == 0, "mgra15_based_input_").otherwise("synthetic_persons_")
    name = fn.lake_name(F.concat(prefix, year)).alias("name")
    return standin(spark, sf, SH).groupBy(name).agg(F.count("*").alias("n"))


@query(
    "k08_append_run",
    f"""{ctes(P)} select 12 as run_id, household_id, SPORDER, nullif(NAICSP, '92') as NAICSP,
    case when AGEP <> 0 then cast(AGEP as double) end as AGEP from person_src""",
)
def _(spark, sf):
    rows = standin(spark, sf, P).select(
        "household_id",
        "SPORDER",
        F.when(F.col("NAICSP") == "92", "").otherwise(F.col("NAICSP")).alias("NAICSP"),
        F.when(F.col("AGEP") == 0, float("nan")).otherwise(F.col("AGEP").cast("double")).alias("AGEP"),
    )
    path = new_stage_path(spark, "append")
    cleaned = sinks.append_run(rows, path, 12)
    return spark.read.schema(cleaned.schema).parquet(path)


@query(
    "k09_clean_numeric_text",
    """with t as (select o_orderkey, case when o_orderkey % 5 = 0 then '' when o_orderkey % 5 = 1
      then cast(o_orderkey as varchar) || '.0' when o_orderkey % 5 = 2 then cast(o_orderkey as varchar) || '.05'
      else cast(o_orderkey as varchar) end as raw from orders)
    select o_orderkey, raw, regexp_replace(nullif(raw, ''), '\\.0$', '') as clean from t""",
)
def _(spark, sf):
    text = F.col("o_orderkey").cast("string")
    kind = F.col("o_orderkey") % 5
    raw = F.when(kind == 0, "").when(kind == 1, F.concat(text, F.lit(".0"))).when(kind == 2, F.concat(text, F.lit(".05")))
    rows = table(spark, sf, "orders").select("o_orderkey", raw.otherwise(text).alias("raw"))
    return rows.withColumn("clean", fn.clean_numeric_text(F.col("raw")))


PERSON_CSV = schema("SERIALNO string, SPORDER int, AGEP int, HISP string, RAC1P string, NAICSP string, PINCP double")


def _csv_copy(spark, sf):
    path = new_stage_path(spark, "csv")
    sinks.write_csv(standin(spark, sf, P).select(*PERSON_CSV.names), path)
    return path


@query(
    "k11_write_csv",
    f"{ctes(P)} select SERIALNO, SPORDER, AGEP, HISP, RAC1P, NAICSP, PINCP from person_src",
)
def _(spark, sf):
    return tables.read_csv(spark, _csv_copy(spark, sf), PERSON_CSV)


@query("s04_read_csv", f"{ctes(*FORECAST)}, {ZONES} select mgra, increment, Total_HH, Total_Pop from zones")
def _(spark, sf):
    path = new_stage_path(spark, "csv")
    sinks.write_csv(zones(spark, sf).select("mgra", "increment", "Total_HH", "Total_Pop"), path)
    return tables.read_csv(spark, path, schema("mgra long, increment int, Total_HH long, Total_Pop long"))


@query(
    "s05_typed_csv",
    f"""{ctes(P)} select SERIALNO, cast(SPORDER as double) as SPORDER, AGEP, HISP, RAC1P, NAICSP, PINCP from person_src""",
)
def _(spark, sf):
    pinned = tables.pin_types(PERSON_CSV, text=("HISP", "NAICSP"), measures=("SPORDER",))
    return tables.read_csv(spark, _csv_copy(spark, sf), pinned)


COMPLETE = "select distinct run_id from run_log where table_name = 'signup'"


@query(
    "t01_ingest_completed",
    f"""{ctes('run_log')} select event_id, value, timestamp '2026-01-01' + to_days(cast(run_id % 10 as int)) as run_timestamp,
    cast(2022 + (run_id % 20) // 10 as int) as year from run_log where run_id % 20 < 12""",
)
def _(spark, sf):
    """Twenty runs share the events, pairs of years one job time; twelve get a marker, eight before the first pick-up."""
    root, target, checkpoint = [new_stage_path(spark, n) for n in ("lake", "ingested", "progress")]
    number = F.expr("cast(run_id % 20 as int)")
    stamp = F.expr("timestamp'2026-01-01 00:00:00'") + F.make_interval(days=number % 10)
    rows = standin(spark, sf, "run_log").select("event_id", "value", stamp.alias("run_timestamp"), number.alias("_run"))
    rows = rows.withColumn("year", (F.lit(2022) + F.floor(F.col("_run") / 10)).cast("int"))
    sinks.publish(rows.drop("_run"), root, "events")

    def mark(first, last):
        """Markers of several runs at once: rows and tables are counted from what was written."""
        published = spark.read.schema(rows.drop("_run").schema).parquet(f"{root}/events")
        number = (F.col("year") - 2022) * 10 + F.date_diff("run_timestamp", F.lit("2026-01-01"))
        counted = published.where(number.between(first, last)).groupBy(*sinks.RUN).agg(F.count("*").alias("n"))
        markers = counted.select(
            "year",
            F.lit(1).alias("succeeded"),
            F.array(F.lit("events")).alias("files"),
            F.create_map(F.lit("events"), "n").alias("rows"),
            "run_timestamp",
        )
        markers.write.mode("append").partitionBy(*sinks.RUN).parquet(f"{root}/{sinks.MARKERS}")

    row_type = "event_id bigint, value double, run_timestamp timestamp, year int"
    mark(0, 7)
    ingest_completed(spark, root, "events", row_type, target, checkpoint)
    mark(8, 11)
    ingest_completed(spark, root, "events", row_type, target, checkpoint)
    return spark.read.schema(row_type).parquet(target)
