"""The validation report of a run: every control compared with the finished population, at every geography."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecraft import definitions as d
from zonecraft.functions import report as fn
from zonecraft.operators import reporting, reshape, summaries
from zonecraft.operators.incidence import of_table
from zonecraft.session import stage

ROWS = ["control_id", "control_field", "geography", "id", "control_value", "result"]


def fitted_controls(controls: Sequence[d.Control] | None = None) -> list[d.Control]:
    return [c for c in (d.fitting_controls() if controls is None else controls) if c.geography == "mgra"]


def household_summaries(
    households: DataFrame,
    persons: DataFrame,
    zone_controls: DataFrame,
    crosswalk: DataFrame,
    controls: Sequence[d.Control] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Zone and PUMA summaries of the household run: control, result and difference per target of ``controls``."""
    chosen = fitted_controls(controls)
    targets = [c.target for c in chosen]
    # Every record stands for itself here, so the total counts records whatever their seed weight was.
    counted = households.where("gq_type = 0").withColumn("WGTP", F.lit(1.0))
    members = reporting.person_population(persons, households)
    totals = zone_controls.select("mgra", *[F.col(c.field).alias(c.target) for c in chosen])
    zones = stage(summaries.zone_summary(counted, members, totals, chosen, ["mgra"]), "zone-summary")
    pumas = summaries.roll_up(zones, crosswalk, targets)
    return summaries.as_geography(zones, "mgra", targets), summaries.as_geography(pumas, "PUMA", targets)


def gq_comparison(households: DataFrame, quarters: DataFrame) -> DataFrame:
    """Zone comparison of the group-quarters runs, told apart by run because all three share one target name."""
    counted = households.where("gq_type <> 0").groupBy("synthesis_run", "mgra").agg(F.count("*").alias("result"))
    joined = quarters.join(counted, ["synthesis_run", "mgra"], "left")
    return joined.select(
        "synthesis_run",
        "control_field",
        F.lit("mgra").alias("geography"),
        F.col("mgra").cast("long").alias("id"),
        F.col("Total_GQ").cast("double").alias("control_value"),
        F.coalesce("result", F.lit(0)).cast("double").alias("result"),
    )


def definition_lines(
    spark: SparkSession, controls: Sequence[d.Control], benchmarks: Sequence[d.Control], archived: DataFrame | None = None
) -> DataFrame:
    """Lines of the definitions of one run as ``resolve_definitions`` takes them: current ones, and those archived with it.

    ``archived``: target, control_field and kind (0 fitting, 1 reporting) in their file order ``ordinal``.
    """
    lines = []
    for kind, own in enumerate((controls, benchmarks)):
        lines += [("run", c.target, c.field, kind, n, 1) for n, c in enumerate(own, 1)]
    schema = "run string, target string, control_field string, kind int, ordinal long, priority int"
    current = spark.createDataFrame(lines, schema)
    if archived is None:
        return current
    old = archived.select(
        F.lit("run").alias("run"),
        "target",
        F.coalesce("control_field", "target").alias("control_field"),
        F.col("kind").cast("int").alias("kind"),
        F.col("ordinal").cast("long").alias("ordinal"),
        F.lit(0).alias("priority"),
    )
    return current.unionByName(old)


def run_definitions(
    spark: SparkSession, controls: Sequence[d.Control], benchmarks: Sequence[d.Control], archived: DataFrame | None = None
) -> DataFrame:
    """``control_id, target, control_field, kind, ordinal`` of one run: archived lines before current ones, fitted controls
    before benchmarks, the first line of a target counts."""
    return stage(reporting.resolve_definitions(definition_lines(spark, controls, benchmarks, archived)), "definitions")


def benchmark_rows(
    households: DataFrame,
    persons: DataFrame,
    zone_controls: DataFrame,
    crosswalk: DataFrame,
    region_summary: DataFrame | None = None,
    benchmarks: Sequence[d.Control] | None = None,
    controls: Sequence[d.Control] | None = None,
    region_controls: DataFrame | None = None,
    definitions: DataFrame | None = None,
) -> DataFrame:
    """Benchmarks of one run and year compared with the finished population, each at its own geography."""
    spark = households.sparkSession
    extra = list(d.reporting_controls() if benchmarks is None else benchmarks)
    fitted = d.fitting_controls() if controls is None else list(controls)
    if region_summary is None:
        reported = spark.createDataFrame([], "target string")
    else:
        reported = region_summary.select(F.col("control_name").alias("target"))
    members = persons if of_table(extra, "persons") else None
    ids = run_definitions(spark, fitted, extra) if definitions is None else definitions
    return reporting.benchmark_comparisons(
        extra, ids, zone_controls, households, members, crosswalk, reported, region_controls
    )


def control_report(
    households: DataFrame,
    persons: DataFrame,
    zone_controls: DataFrame,
    quarters: DataFrame,
    crosswalk: DataFrame,
    region_summary: DataFrame | None = None,
    benchmarks: Sequence[d.Control] | None = None,
    controls: Sequence[d.Control] | None = None,
    region_controls: DataFrame | None = None,
    archived: DataFrame | None = None,
) -> DataFrame:
    """Report table of one run and year: household, regional and group-quarters controls, and benchmarks.

    ``region_summary``: control_name, control_value and the weighted total per stage, as written by the synthesis.
    ``controls`` are the fitted definitions (the published set by default); ``archived`` are definition lines kept with the
    run, which decide its control numbers before the current ones.
    """
    spark = households.sparkSession
    extra = list(d.reporting_controls() if benchmarks is None else benchmarks)
    fitted_set = d.fitting_controls() if controls is None else list(controls)
    ids = run_definitions(spark, fitted_set, extra, archived)
    by_area = household_summaries(households, persons, zone_controls, crosswalk, fitted_set)
    parts = [reshape.melt_summary(s) for s in by_area]
    if region_summary is not None:
        parts.append(reshape.region_constants(region_summary))
    fitted = reporting.attach_definitions(reporting.stack(parts), ids).select(*ROWS)
    numbers = reporting.number_gq_runs(quarters, ids.agg(F.max("control_id")).first()[0] or 0)
    gq = gq_comparison(households, quarters).join(numbers, "synthesis_run").select(*ROWS)
    status = lambda rows: rows.withColumn("Status", F.lit(fn.FITTING))
    compared = [status(fitted), status(gq)]
    if extra:
        found = benchmark_rows(
            households, persons, zone_controls, crosswalk, region_summary, extra, fitted_set, region_controls, ids
        )
        compared.append(found.select(*ROWS, "Status"))
    return reporting.report_table(reporting.stack(compared))
