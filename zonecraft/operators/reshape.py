"""Wide summaries to long comparisons and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROL, RESULT, DIFF = "_control", "_result", "_diff"


def paired_targets(columns: Sequence[str]) -> list[str]:
    """Targets that have both a control and a result column. Only the suffix is taken off a name."""
    with_control = [c.removesuffix(CONTROL) for c in columns if c.endswith(CONTROL)]
    return [t for t in with_control if t + RESULT in columns]


def melt_summary(summary: DataFrame, keys: Sequence[str] = ("geography", "id")) -> DataFrame:
    """One row per area and target, in a single pass without a join; geography in lower case."""
    pairs = [
        F.struct(
            F.lit(t).alias("target"),
            F.col(t + CONTROL).cast("double").alias("control_value"),
            F.col(t + RESULT).cast("double").alias("result"),
        )
        for t in paired_targets(summary.columns)
    ]
    return summary.select(*keys, F.inline(F.array(*pairs))).withColumn("geography", F.lower("geography"))


def melt_side(summary: DataFrame, suffix: str, value: str, keys: Sequence[str] = ("geography", "id")) -> DataFrame:
    """Only the control columns, or only the result columns, long."""
    columns = [c for c in summary.columns if c.endswith(suffix)]
    long = summary.unpivot(list(keys), columns, "target", value)
    return long.select(
        *keys, F.regexp_replace("target", suffix + "$", "").alias("target"), F.col(value).cast("double").alias(value)
    )


def join_melted(controls: DataFrame, results: DataFrame) -> DataFrame:
    """Controls and results that were melted from separate tables; only pairs present in both remain."""
    return controls.join(results, ["geography", "id", "target"])


def widen(comparison: DataFrame, area: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """Zone summary: control, result and difference columns per target, in the order of ``targets``."""
    wide = (
        comparison.groupBy(*area)
        .pivot("target", list(targets))
        .agg(F.first("control_value", True).alias("control"), F.first("result", True).alias("result"))
    )
    columns = []
    for t in targets:
        control, result = F.col(f"`{t}{CONTROL}`"), F.col(f"`{t}{RESULT}`")
        columns += [control, result, (result - control).alias(t + DIFF)]
    return wide.select(*area, *columns)


def region_constants(region_summary: DataFrame, stage: str = "mgra_integer_weight") -> DataFrame:
    """Region summary rows in the shape of the melted zone summaries."""
    return region_summary.select(
        F.lit("region").alias("geography"),
        F.lit(1).cast("long").alias("id"),
        F.col("control_name").alias("target"),
        F.col("control_value").cast("double").alias("control_value"),
        F.col(stage).cast("double").alias("result"),
    )
