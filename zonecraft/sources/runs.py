"""Catalogue of runs, their status, and reads limited to completed runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecraft.functions.report import display_year

RUN = ("year", "run_timestamp")
REQUIRED_TABLES = ("timing_log", "synthetic_households", "synthetic_persons")


def run_catalog(tables: DataFrame, required: tuple[str, ...] = REQUIRED_TABLES) -> DataFrame:
    """Runs for which every required table exists. Distinct tables per run are flags, so they combine map-side."""
    present = [F.max(F.when(F.col("table_name") == t, F.col("ts"))).alias(f"_{n}") for n, t in enumerate(required)]
    found = tables.groupBy("run").agg(*present).dropna("any", subset=[f"_{n}" for n in range(len(required))])
    return found.select(
        F.concat("run", F.lit("_local")).alias("run_id"),
        F.col("run").alias("folder"),
        display_year(F.col("run")).alias("year"),
        F.date_format("_0", "yyyy-MM-dd HH:mm").alias("date"),
        F.lit("local").alias("version"),
        F.lit("local").alias("source"),
    )


def latest_status(events: DataFrame, run: str = "run_id") -> DataFrame:
    """Current ``loaded`` flag per run from appended status events; nothing is updated in place."""
    return events.groupBy(run).agg(F.max_by("loaded", F.struct("ts", "event_id")).alias("loaded"))


def loaded_runs(runs: DataFrame) -> DataFrame:
    return runs.where("loaded")


def latest_first(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.col("date").desc(), F.col("run_id").desc())


def rows_of_runs(data: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows of the given runs (year and time; the year may be NULL).

    Runs are few and the folders of a table are named after them, so the runs are told to the scan when it starts, and
    folders of other runs are not opened.
    """
    # No time is written as nothing; said as a comparison, Spark takes it for a reason to prune.
    known = runs.select(*RUN).distinct().where("cast(run_timestamp as string) > ''")
    dated = data.join(known.where("year is not null"), list(RUN), "left_semi")
    undated = known.where("year is null").select("run_timestamp")
    return dated.unionByName(data.where("year is null").join(undated, "run_timestamp", "left_semi"))


def read_completed(data: DataFrame, markers: DataFrame) -> DataFrame:
    """Rows of runs whose completion marker exists."""
    written = markers.where("succeeded >= 0") if "succeeded" in markers.columns else markers
    return rows_of_runs(data, written)
