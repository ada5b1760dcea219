"""Sinks: published Parquet tables with run columns, completion markers, appended status and CSV."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from zonecraft.functions.report import clean_numeric_text, timestamp_key
from zonecraft.schemas import SEED_TEXT_COLUMNS

# All years of one job share its time, so a run is known by both.
RUN = ("year", "run_timestamp")
RUN_KEYS = ["table_name", *RUN]
MARKERS = "_export_status"
MARKER_SCHEMA = "year int, run_timestamp timestamp, succeeded int, files array<string>, rows map<string,bigint>"


def with_run(df: DataFrame, year: int | Column | None, run_timestamp: Column) -> DataFrame:
    """Add the run's columns. The year is left out for runs whose folder is no plain year."""
    stamped = df.withColumn("run_timestamp", run_timestamp)
    if year is None:
        return stamped
    return stamped.withColumn("year", (F.lit(year) if isinstance(year, int) else year).cast("int"))


def folder_year(folder: str) -> int | None:
    return int(folder) if folder.isdigit() else None


def controls_table(definitions: DataFrame, synthesis_run: str) -> DataFrame:
    return definitions.withColumn("synthesis_run", F.lit(synthesis_run))


def text_codes(seed: DataFrame) -> DataFrame:
    """Seed records with their code columns pinned to text."""
    return seed.withColumns({c: F.col(c).cast("string") for c in SEED_TEXT_COLUMNS if c in seed.columns})


def seed_table(seed: DataFrame, synthesis_run: str) -> DataFrame:
    return text_codes(seed).withColumn("synthesis_run", F.lit(synthesis_run))


def run_metadata(
    spark: SparkSession, year: int | None, config: Mapping[str, object], batch_id: str, user: str, run_timestamp: Column
) -> DataFrame:
    """One row describing a run: every top-level setting, nested ones as JSON text."""
    plain = {k: json.dumps(v) if isinstance(v, (dict, list)) else v for k, v in config.items()}
    row = {"year": year, "batch_id": batch_id, "user": user, **plain}
    columns = [F.lit(v).cast("string").alias(k) if k != "year" else F.lit(v).cast("int").alias(k) for k, v in row.items()]
    return spark.range(1).select(*columns, run_timestamp.alias("run_timestamp"))


def read_if_exists(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table, or no rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def with_year(df: DataFrame) -> DataFrame:
    """Runs whose folder is no plain year have a NULL year."""
    return df if "year" in df.columns else df.withColumn("year", F.lit(None).cast("int"))


def only_new(rows: DataFrame, published: DataFrame, keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    """Rows of runs that are not published yet, so publishing again adds nothing. A NULL key equals a NULL key."""
    done = published.select(*[F.col(k).alias(f"_done_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(done[f"_done_{k}"]) for k in keys])
    return rows.join(done, same, "left_anti")


def marked_rows(spark: SparkSession, root: str) -> DataFrame:
    """Every published table of every finished run with the rows its marker names."""
    markers = read_if_exists(spark, f"{root.rstrip('/')}/{MARKERS}", MARKER_SCHEMA)
    return markers.select(*RUN, F.explode("rows").alias("table_name", "rows"))


def publish(df: DataFrame, root: str, name: str, partitions: Sequence[str] = RUN) -> str:
    """Append a table under its lake name, one folder per year and run. Runs that are already there are left as they are.

    Writes replace whole partitions, so a retry after a failed write cannot leave a run twice or half written.
    """
    publish_counted(df, root, name, partitions)
    return f"{root.rstrip('/')}/{name}"


def publish_counted(df: DataFrame, root: str, name: str, partitions: Sequence[str] = RUN) -> int:
    """``publish``, and the rows that were written, as the write itself has seen them."""
    path = f"{root.rstrip('/')}/{name}"
    rows = with_year(df)
    keys = [p for p in partitions if p in rows.columns]
    # Only finished runs count as published: their marker names the table.
    done = read_if_exists(df.sparkSession, f"{root.rstrip('/')}/{MARKERS}", MARKER_SCHEMA)
    seen = Observation()
    fresh = only_new(rows, done.where(F.array_contains("files", name)), RUN).observe(seen, F.count(F.lit(1)).alias("rows"))
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    return seen.get["rows"]


def count_published(
    spark: SparkSession, root: str, year: int | None, names: Sequence[str], run_timestamp: Column
) -> DataFrame:
    """Rows per published table of one run, read back from what was written."""
    of_year = F.col("year").cast("int").eqNullSafe(F.lit(year).cast("int"))
    counted = [
        spark.read.parquet(f"{root.rstrip('/')}/{n}")
        .where(of_year & (F.col("run_timestamp") == run_timestamp))
        .agg(F.count("*").alias("rows"))
        .select(F.lit(n).alias("table_name"), "rows")
        for n in names
    ]
    return reduce(lambda a, b: a.unionByName(b), counted)


def mark_complete(
    spark: SparkSession, root: str, year: int | None, written: Sequence[str] | Mapping[str, int], run_timestamp: Column
) -> None:
    """Write the run's completion marker, last of all: tables and rows. Marking again replaces the marker.

    ``written`` maps tables to the rows their writes have seen; of plain names the rows are counted from the tables.
    """
    if isinstance(written, Mapping):
        counted = spark.createDataFrame(list(written.items()), "table_name string, rows long")
    else:
        counted = count_published(spark, root, year, written, run_timestamp)
    marker = counted.agg(
        F.lit(year).cast("int").alias("year"),
        F.count("*").cast("int").alias("succeeded"),
        F.array_sort(F.collect_list("table_name")).alias("files"),
        F.map_from_entries(F.collect_list(F.struct("table_name", "rows"))).alias("rows"),
    ).withColumn("run_timestamp", run_timestamp)
    stamped = marker.select("year", "succeeded", "files", "rows", "run_timestamp")
    path = f"{root.rstrip('/')}/{MARKERS}"
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*RUN).parquet(path)


def append_run(df: DataFrame, path: str, run_id: int | Column) -> DataFrame:
    """Rows for a run-keyed table: empty text and NaN are NULL, the run id is added.

    Each run is a folder of its own, which a repeated load replaces, so a retry cannot leave a run's rows twice.
    """
    cleaned = clean_for_load(df).withColumn("run_id", F.lit(run_id) if isinstance(run_id, int) else run_id)
    cleaned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)
    return cleaned


def clean_for_load(df: DataFrame) -> DataFrame:
    def clean(name: str, kind: str) -> Column:
        c = F.col(name)
        if kind == "string":
            return clean_numeric_text(c)
        return F.when(~F.isnan(c), c) if kind in ("double", "float") else c

    return df.select(*[clean(name, kind).alias(name) for name, kind in df.dtypes])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def batch_id(job_time: Column) -> Column:
    """Identifier all years of one job share."""
    return timestamp_key(job_time)
