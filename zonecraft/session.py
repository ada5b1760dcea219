"""Session settings and the shared folder that stage tables are written to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime settings the operators count on. Skewed joins are split by AQE, also where that costs a later shuffle.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows that carry a seed pool's arrays are tens of kilobytes wide.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def build_session(app_name: str = "zonecraft", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false").config(
        "spark.ui.showConsoleProgress", "false"
    )
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else has built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def stage_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a fresh local one only in local mode."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="zonecraft-"))
    return context.getCheckpointDir().rstrip("/")


def new_stage_path(spark: SparkSession, name: str = "stage") -> str:
    return f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_made: ContextVar[list | None] = ContextVar("stage tables made in the innermost block", default=None)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run inside go when the query has ended, not when the driver collects its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Stage tables made inside are deleted at the end, but those passed through the function that it gives.

    What leaves the block must not read any other of them.
    """
    outer, inner, kept = _made.get(), [], []
    token = _made.set(inner)

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table.stage_path)
        return table

    try:
        yield keep
    finally:
        _made.reset(token)
        for table in inner:
            if table.stage_path not in kept:
                drop_stage(table)
            elif outer is not None:
                outer.append(table)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage, survives executor loss, and gives Spark true sizes."""
    spark = df.sparkSession
    path = new_stage_path(spark, name)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    return _noted(table, path)


def _noted(table: DataFrame, path: str) -> DataFrame:
    table.stage_path = path
    if _made.get() is not None:
        _made.get().append(table)
    return table


def stage_bucketed(
    df: DataFrame,
    keys: Sequence[str],
    name: str = "stage",
    finish: Callable[[DataFrame], DataFrame] = lambda dealt: dealt,
    parts: int = 1,
) -> DataFrame:
    """``stage`` as a table dealt into buckets by ``keys`` and sorted by them: joins and groups on them need no shuffle of it.

    As many buckets as Spark shuffles into, one file each; the table's name is known to this session's catalog only.
    ``finish`` adds columns to the rows where they have been dealt, so that these are not shuffled. Of several ``parts``, each
    with buckets of its own, one is shuffled at a time; ``df`` is read as often.
    """
    spark = df.sparkSession
    path = new_stage_path(spark, name)
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"stage_{uuid.uuid4().hex}"
    part = F.pmod(F.pmod(F.hash(*keys), F.lit(count)), F.lit(parts))
    with shuffles_dropped(spark):
        for k in range(parts):
            own = df.where(part == k) if parts > 1 else df
            dealt = finish(own.repartition(count, *keys)).write.format("parquet").bucketBy(count, *keys).sortBy(*keys)
            dealt.option("path", path).mode("append").saveAsTable(table)
    return _noted(spark.table(table), path)


def drop_stage(table: DataFrame) -> None:
    """Delete a staged table that no later step reads."""
    spark = table.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(table.stage_path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
