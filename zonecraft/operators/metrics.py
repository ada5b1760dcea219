"""Accuracy and timing measures of finished runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Largest acceptable deviation of total households per geography.
HOUSEHOLD_LIMITS = {"region": 50, "puma": 25, "mgra": 2}
# Acceptable mean absolute error and mean percent error per group of controls.
ERROR_LIMITS = {
    "Sex": (3, 3),
    "Age": (5, 5),
    "Race/Ethnicity": (4, 8),
    "Household Size": (2, 10),
    "Household Income": (3, 12),
}
# Acceptable maximum difference, maximum percent and total difference of the employment controls.
EMPLOYMENT_LIMITS = (20, 0.5, 100)


def _share(condition: Column) -> Column:
    return 100.0 * F.count_if(condition) / F.count("*")


def household_accuracy(comparison: DataFrame, target: str = "Total_HH") -> DataFrame:
    """Areas hit exactly, within one and within two households, per geography, and a grade by the worst area."""
    size = F.abs(F.col("result") - F.col("control_value"))
    limit = F.coalesce(
        *[F.when(F.col("geography") == g, F.lit(v)) for g, v in HOUSEHOLD_LIMITS.items()], F.lit(0)
    )
    kept = comparison.where(F.col("target") == target)
    return kept.groupBy("geography").agg(
        F.count("*").alias("areas"),
        F.count_if(size == 0).alias("exact"),
        F.count_if(size <= 1).alias("within_1"),
        F.count_if(size <= 2).alias("within_2"),
        _share(size == 0).alias("pct_exact"),
        _share(size <= 1).alias("pct_within_1"),
        _share(size <= 2).alias("pct_within_2"),
        F.max(size).alias("worst"),
        F.when(F.max(size - limit) <= 0, "acceptable").otherwise("review").alias("grade"),
    )


def error_by_target(comparison: DataFrame, keys: Sequence[str] = ("target",)) -> DataFrame:
    """Mean absolute error, and mean absolute percent error over areas with a positive control."""
    size = F.abs(F.col("result") - F.col("control_value"))
    relative = F.when(F.col("control_value") > 0, 100.0 * size / F.col("control_value"))
    return comparison.groupBy(*keys).agg(F.avg(size).alias("mae"), F.avg(relative).alias("mape"))


def grade_errors(errors: DataFrame, category: str = "Category") -> DataFrame:
    """Compare the errors with the limits of their category; NULL where a category has no limits."""
    ok = F.lit(None).cast("boolean")
    for name, (mae, mape) in ERROR_LIMITS.items():
        ok = F.when(F.col(category) == name, (F.col("mae") <= mae) & (F.col("mape") <= mape)).otherwise(ok)
    return errors.withColumn("acceptable", ok)


def employment_accuracy(comparison: DataFrame, prefix: str = "job_") -> DataFrame:
    control, delta = F.col("control_value"), F.col("result") - F.col("control_value")
    kept = comparison.where(F.col("target").startswith(prefix))
    largest, percent, total = EMPLOYMENT_LIMITS
    measured = kept.groupBy("geography").agg(
        F.max(F.abs(delta)).alias("max_diff"),
        F.max(F.when(control > 0, 100.0 * F.abs(delta) / control)).alias("max_pct"),
        F.sum(F.abs(delta)).alias("total_diff"),
    )
    fine = (F.col("max_diff") <= largest) & (F.col("max_pct") <= percent) & (F.col("total_diff") <= total)
    return measured.withColumn("grade", F.when(fine, "acceptable").otherwise("review"))


def exact_match_rate(comparison: DataFrame, prefix: str = "GQ_") -> DataFrame:
    """Share of areas where a group-quarters control is hit exactly; anything below all of them is critical."""
    hit = F.col("control_value") == F.col("result")
    return (
        comparison.where(F.col("target").startswith(prefix))
        .groupBy("target")
        .agg(F.count_if(hit).alias("exact"), F.count("*").alias("areas"), _share(hit).alias("pct_exact"))
        .withColumn("status", F.when(F.col("exact") == F.col("areas"), "ok").otherwise("critical"))
    )


def run_timing(steps: DataFrame) -> DataFrame:
    """Total seconds per run and the mean of its balancing steps."""
    return steps.groupBy("run_id").agg(
        F.sum("seconds").alias("total_seconds"),
        F.avg(F.when(F.col("model_name").contains("balancing"), F.col("seconds").cast("double"))).alias("mean_balancing"),
    )


def largest_per(df: DataFrame, keys: Sequence[str], measure: str, tie: str, k: int) -> DataFrame:
    """The k rows of the largest measure per key. Spark keeps k rows per key and task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.col(measure).desc(), F.col(tie))
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def worst_areas(comparison: DataFrame, target: str, k: int) -> DataFrame:
    size = F.abs(F.col("result") - F.col("control_value"))
    kept = comparison.where(F.col("target") == target).withColumn("abs_diff", size)
    return kept.orderBy(F.col("abs_diff").desc(), "geography", "id").limit(k)


def deviation_by_target(comparison: DataFrame, geography: str = "puma") -> DataFrame:
    """Control and result summed over the areas of one geography, with difference and percent."""
    kept = comparison.where(F.col("geography") == geography)
    summed = kept.groupBy("target").agg(F.sum("control_value").alias("control"), F.sum("result").alias("result"))
    delta = F.col("result") - F.col("control")
    return summed.withColumns(
        {"diff": delta, "pct": F.when(F.col("control") != 0, 100.0 * delta / F.col("control"))}
    )


def next_run_id(runs: DataFrame) -> DataFrame:
    return runs.agg(F.coalesce(F.max("run_id") + 1, F.lit(1)).alias("next_run_id"))
