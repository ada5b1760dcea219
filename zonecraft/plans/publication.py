"""Publish everything a run produced; the completion marker comes last."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecraft import definitions as d
from zonecraft.operators.controls import land_use_output
from zonecraft.operators.reporting import export_benchmarks, stack
from zonecraft.plans import validation
from zonecraft.plans.synthesis import YEAR, Result
from zonecraft.sources import publish as sinks


def definition_tables(spark: SparkSession, controls: Sequence[d.Control] | None = None) -> dict[str, DataFrame]:
    """Control definitions of every run, and those that are compared without being fitted."""
    runs = {"household": d.fitting_controls() if controls is None else list(controls)} | {run: [control] for run, control in d.gq_controls().items()}
    frames = [sinks.controls_table(d.definitions_frame(spark, controls), run) for run, controls in runs.items()]
    return {"controls": stack(frames), "reporting_controls": d.definitions_frame(spark, d.reporting_controls())}


def run_tables(
    result: Result,
    year: int,
    crosswalk: DataFrame | None = None,
    mgrabase: DataFrame | None = None,
    controls: Sequence[d.Control] | None = None,
) -> dict[str, DataFrame]:
    """Tables of one year, by lake name. Seeds do not depend on the year and are published with every run. Summaries and
    benchmarks need the crosswalk, the land-use table its source."""
    of_year = lambda df: df.where(F.col(YEAR) == year).drop(YEAR)
    households, persons, zones = [of_year(t) for t in (result.households, result.persons, result.controls.zones)]
    region = of_year(result.region_summary)
    tables = {
        "synthetic_households": households,
        "synthetic_persons": persons,
        "mgra_controls": zones,
        "mgra_controls_gq": of_year(result.controls.quarters),
        "region_controls": of_year(result.controls.region),
        "seed_households": sinks.text_codes(result.seeds.households),
        "seed_persons": sinks.text_codes(result.seeds.persons),
        "final_summary_region_1": region,
        **definition_tables(households.sparkSession, controls),
    }
    if crosswalk is not None:
        by_zone, by_puma = validation.household_summaries(households, persons, zones, crosswalk, controls)
        benchmarks = validation.benchmark_rows(
            households, persons, zones, crosswalk, region, controls=controls, region_controls=of_year(result.controls.region)
        )
        tables |= {
            "final_summary_mgra": by_zone,
            "final_summary_mgra_puma": by_puma,
            "benchmark_comparisons": export_benchmarks(benchmarks),
        }
    if mgrabase is not None:
        tables[lake_name_of(f"mgra15_based_input_{year}")] = of_year(land_use_output(mgrabase))
    return tables


def lake_name_of(name: str) -> str:
    """A table's lake name: a year at its end is no part of it."""
    return re.sub(r"_\d{4}$", "", name)


def publish_run(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    year: int | None,
    run_timestamp: str,
    config: Mapping[str, object],
    batch_id: str,
    user: str,
) -> list[str]:
    """Write each table with the run's columns. A failing write stops the job before the marker exists, and a second
    attempt replaces what the first one left. The marker names the rows that the writes have seen; of a run that was
    finished before, it keeps those of then."""
    stamp = F.to_timestamp(F.lit(run_timestamp))
    same = F.col("year").eqNullSafe(F.lit(year).cast("int")) & (F.col("run_timestamp") == stamp)
    before = {r.table_name: r.rows for r in sinks.marked_rows(spark, root).where(same).collect()}
    metadata = sinks.run_metadata(spark, year, config, batch_id, user, stamp)
    written = {}
    for name, table in {**{n: sinks.with_run(t, year, stamp) for n, t in tables.items()}, "run_metadata": metadata}.items():
        rows = sinks.publish_counted(table, root, name)
        written[name] = before.get(name, rows)
    sinks.mark_complete(spark, root, year, {**before, **written}, stamp)
    return list(written)
