"""Ordered numbering and running totals that never put one group into one task.

A plain window over a hot group sorts that whole group in a single task. Here rows are range-partitioned on
``(group, order)``, so a hot group spans many partitions; each partition keeps its own running total and is shifted
by the totals of the partitions before it. The partition layout is written once, so a lost executor cannot change it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecraft.session import stage


def _order_columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o).asc() if isinstance(o, str) else o for o in order]


def running_total(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], amount: str, into: str
) -> DataFrame:
    """Add ``into``: the sum of ``amount`` over the rows of the group that come before this one.

    ``order`` must be unique within a group and group columns must not be NULL.
    """
    ordering = _order_columns(order)
    keys = ["_part", *group]
    placed = stage(
        df.repartitionByRange(*[F.col(g) for g in group], *ordering).withColumn("_part", F.spark_partition_id()),
        "running",
    )
    before = (Window.unboundedPreceding, -1)
    within = Window.partitionBy(*keys).orderBy(*ordering).rowsBetween(*before)
    # One row per partition and group it holds: its size follows the partition count, not the data.
    across = Window.partitionBy(*group).orderBy("_part").rowsBetween(*before)
    shifts = (
        placed.groupBy(*keys)
        .agg(F.sum(amount).alias("_total"))
        .withColumn("_shift", F.coalesce(F.sum("_total").over(across), F.lit(0)))
        .drop("_total")
    )
    return (
        placed.withColumn("_within", F.coalesce(F.sum(amount).over(within), F.lit(0)))
        .join(shifts, keys)
        .withColumn(into, F.col("_within") + F.col("_shift"))
        .drop("_part", "_within", "_shift")
    )


def number_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], into: str = "number"
) -> DataFrame:
    """1-based row number within each group, equal to ``row_number()`` over a unique ordering."""
    counted = running_total(df.withColumn("_one", F.lit(1).cast("long")), group, order, "_one", into)
    return counted.withColumn(into, F.col(into) + 1).drop("_one")


def exact_median(df: DataFrame, group: Sequence[str], value: str, into: str) -> DataFrame:
    """Exact median per group from value counts, so a hot group is pre-aggregated and spread before it is ordered."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_n"))
    placed = running_total(counts, group, [value], "_n", "_before")
    totals = placed.groupBy(*group).agg(F.sum("_n").alias("_all"))
    low = F.floor((F.col("_all") - 1) / 2)
    high = F.floor(F.col("_all") / 2)
    covers = lambda position: (F.col("_before") <= position) & (position < F.col("_before") + F.col("_n"))
    return (
        placed.join(totals, list(group))
        .where(covers(low) | covers(high))
        .groupBy(*group)
        .agg(((F.min(value) + F.max(value)) / 2).alias(into))
    )
