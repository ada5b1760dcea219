"""Key rules that joins rely on, checked inside the plan instead of by a separate pass over the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fail_if(condition: Column, message: str, value: Column) -> Column:
    """``value``, or a failed job with ``message`` on the first row where the condition holds."""
    return F.when(condition, F.raise_error(F.lit(message))).otherwise(value)


def one_row_per(df: DataFrame, keys: Sequence[str], message: str) -> DataFrame:
    """The same rows; the job fails if a key occurs twice. Counts are combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.any_value(c).alias(c) for c in rest])
    checked = fail_if(F.col("_n") > 1, message, F.col(keys[0])).alias(keys[0])
    return grouped.select(checked, *keys[1:], *rest)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the lowest ``order`` per key, as an aggregate: each task keeps one row per key, however hot it is."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return kept.select(*keys, "_first.*").select(*df.columns)
