"""Incremental pick-up of published tables: a stream of completion markers decides what is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecraft.session import stage
from zonecraft.sources.publish import MARKER_SCHEMA, MARKERS, RUN
from zonecraft.sources.runs import rows_of_runs


def ingest_completed(
    spark: SparkSession, root: str, table: str, schema: str, target: str, checkpoint: str, wait: bool = True
):
    """Copy every run (year and time) of ``table`` that has a marker to ``target``, each run once. ``schema`` names both.

    The stream tracks marker files, so a run still being written is never seen. Which runs have been admitted is the
    stream's keyed state, kept with its checkpoint: a marker that is written again, comes late or is read again after a
    restart admits nothing, and the target is never read. A marker that does not name the table yet is no admission. A
    run's rows replace the run's own partition, so a batch that is replayed after a failure leaves the same result.
    """
    markers = spark.readStream.schema(MARKER_SCHEMA).parquet(f"{root.rstrip('/')}/{MARKERS}")
    named = markers.where((F.col("succeeded") > 0) & F.array_contains("files", table))
    admitted = named.select(*RUN).dropDuplicates(list(RUN))

    def copy(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        rows = session.read.schema(schema).parquet(f"{root.rstrip('/')}/{table}")
        # Written, the few runs of a batch have a known size, so the scan below is pruned to their folders.
        chosen = rows_of_runs(rows, stage(batch, "admitted"))
        chosen.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*RUN).parquet(target)

    query = admitted.writeStream.foreachBatch(copy).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if wait:
        query.awaitTermination()
    return query
