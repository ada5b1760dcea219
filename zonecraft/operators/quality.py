"""Data-quality checks. Each returns the rows (or per-group counts) that break a rule; empty means passed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecraft.definitions import AGE_BANDS, RACE_CONTROLS

# Codes a valid crosswalk and a valid industry sector may have.
PUMA_RANGE = (7301, 7322)
ZONE_RANGE = (1, 30000)
INCOME_RANGE = (0, 9_999_999)
ADJUSTMENT_RANGE = (1.07, 1.22)
GROWTH_RANGE = (-0.10, 0.20)


def verdict(name: str, violations: DataFrame) -> DataFrame:
    """One row: the check's name, how many rows break it, and whether it passed."""
    return violations.agg(F.count("*").alias("violations")).select(
        F.lit(name).alias("check"), "violations", (F.col("violations") == 0).alias("passed")
    )


def enforce(name: str, violations: DataFrame) -> None:
    """Stop the job if a check finds anything; only one row comes back to the caller."""
    found = verdict(name, violations).first()
    if not found["passed"]:
        raise ValueError(f"{name}: {found['violations']} rows break the rule")


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    return children.join(parents.select(key), key, "left_anti")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column", "nulls")


def coverage(df: DataFrame, area: str, weight: str) -> DataFrame:
    return df.agg(F.count_distinct(area).alias("areas"), F.sum(weight).alias("weight"), F.count("*").alias("records"))


def missing_classification(households: DataFrame) -> DataFrame:
    return households.where(F.col("gq_type").isNull())


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def missing_in_crosswalk(controls: DataFrame, crosswalk: DataFrame) -> DataFrame:
    return controls.select("mgra").distinct().join(crosswalk.select("mgra"), "mgra", "left_anti")


def household_size_gap(controls: DataFrame) -> DataFrame:
    """Zones where the size classes do not add up to all households."""
    sizes = F.col("HHSize_1") + F.col("HHSize_2") + F.col("HHSize_3") + F.col("HHSize_4Plus")
    return controls.withColumn("gap", F.col("Total_HH") - sizes).where(F.abs("gap") >= 1)


def population_gap(controls: DataFrame) -> DataFrame:
    """Zones where age, sex and race do not add up to the same population."""
    total = lambda names: reduce(lambda a, b: a + b, [F.col(n) for n in names])
    sums = controls.withColumns(
        {
            "by_age": total([n for n, _, _ in AGE_BANDS]),
            "by_sex": total(["Male", "Female"]),
            "by_race": total(list(RACE_CONTROLS)),
        }
    )
    return sums.where((F.col("by_age") != F.col("by_sex")) | (F.col("by_sex") != F.col("by_race")))


def not_in_controls(crosswalk: DataFrame, controls: DataFrame) -> DataFrame:
    return crosswalk.join(controls.select("mgra"), "mgra", "left_anti")


def invalid_crosswalk(crosswalk: DataFrame, region: int = 1) -> DataFrame:
    ok = F.col("PUMA").between(*PUMA_RANGE) & F.col("mgra").between(*ZONE_RANGE) & (F.col("region") == region)
    return crosswalk.where(~F.coalesce(ok, F.lit(False)))


def employment_gap(region_controls: DataFrame) -> DataFrame:
    """Regions and years with a negative military total, or with fewer in the labour force than jobs."""
    add = lambda prefix: reduce(
        lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in region_controls.columns if c.startswith(prefix)]
    )
    summed = region_controls.withColumns({"jobs": add("job_"), "labor_force": add("lfp_")})
    return summed.where((F.col("job_2") < 0) | (F.col("labor_force") < F.col("jobs"))).select(
        "region", "year", "job_2", "jobs", "labor_force"
    )


def growth_outliers(totals: DataFrame, keys: Sequence[str], year: str, value: str) -> DataFrame:
    """Year-over-year growth out of range. Totals hold one row per key and year, so a window group is a few years."""
    w = Window.partitionBy(*keys).orderBy(year)
    before = F.lag(value).over(w)
    rate = F.when(before != 0, (F.col(value) - before) / before)
    return totals.withColumn("growth", rate).where(
        (F.col("growth") <= GROWTH_RANGE[0]) | (F.col("growth") >= GROWTH_RANGE[1])
    )


def income_check(households: DataFrame) -> DataFrame:
    """Incomes out of range, and whether the mean adjustment is plausible."""
    low, high = ADJUSTMENT_RANGE
    both = F.col("HINCP").isNotNull() & F.col("HHADJINC").isNotNull()
    mean = lambda c: F.avg(F.when(both, F.col(c)))
    return households.agg(
        F.count_if(~F.col("HHADJINC").between(*INCOME_RANGE)).alias("out_of_range"),
        (mean("HHADJINC") / mean("HINCP")).alias("ratio"),
    ).withColumn("plausible", F.col("ratio").between(low, high))


def impossible_workers(households: DataFrame) -> DataFrame:
    return households.where((F.col("workers") < 0) | (F.col("workers") > F.col("NP")))


def invalid_codes(persons: DataFrame) -> DataFrame:
    """Persons without a valid race label or with an industry sector of the wrong form, counted per value pair."""
    sector = F.col("NAICS2")
    good_sector = sector.isNull() | (sector == "MIL") | (F.length(sector) == 2) | sector.isin("721", "722")
    good_race = F.coalesce(F.col("race").isin(*RACE_CONTROLS.values()), F.lit(False))
    return persons.where(~good_race | ~good_sector).groupBy("race", "NAICS2").agg(F.count("*").alias("n"))


def merged_population_check(households: DataFrame) -> DataFrame:
    """Per run: records, ids that occur more than once in the whole table, and records of another run's type."""
    from zonecraft.definitions import GQ_RUNS

    expected = F.coalesce(
        *[F.when(F.col("synthesis_run") == name, F.lit(code)) for name, code, *_ in GQ_RUNS], F.lit(0)
    )
    repeated = duplicate_keys(households, ["household_id"]).select("household_id", F.lit(1).alias("_repeated"))
    return (
        households.join(repeated, "household_id", "left")
        .groupBy("synthesis_run")
        .agg(
            F.count("*").alias("records"),
            F.count_if(F.col("_repeated").isNotNull()).alias("repeated_ids"),
            F.count_if(~F.col("gq_type").eqNullSafe(expected)).alias("wrong_type"),
        )
    )


def parts_gap(totals: DataFrame, whole: str, parts: Sequence[str]) -> DataFrame:
    """Rows where the parts do not add up to the whole."""
    added = reduce(lambda a, b: a + b, [F.col(p) for p in parts])
    return totals.withColumn("gap", F.col(whole) - added).where("gap <> 0")


def level_gap(zone_totals: DataFrame, region_totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Zone totals against the region's own total. Both are already one row per key."""
    joined = zone_totals.join(region_totals, list(keys), "full_outer")
    return joined.withColumn("gap", F.col("zone_total") - F.col("region_total")).where(
        F.col("gap").isNull() | (F.col("gap") != 0)
    )


def type_drift(df: DataFrame, expected: dict[str, str], group: Sequence[str] = ()) -> DataFrame:
    """Values per text column that cannot be read as the declared type, per group."""
    failed = lambda c, t: F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c)
    wide = df.groupBy(*group).agg(*[failed(c, t) for c, t in expected.items()])
    return wide.unpivot(list(group), list(expected), "column", "failures")


def schema_drift(schemas: DataFrame, run: Sequence[str] = ("year", "run_timestamp")) -> DataFrame:
    """Columns that a run's files hold in another type than most runs, or lack: run, ``column``, ``kind`` (NULL: missing),
    ``usual`` and ``files``. ``schemas``: run, file, column, kind, as ``published_schemas`` reads them.

    Of equally usual types the first by name counts. A run whose files disagree is named for each of their types.
    """
    run = list(run)
    kinds = schemas.groupBy(*run, "column", "kind").agg(F.count("*").alias("files"))
    votes = kinds.groupBy("column", "kind").agg(F.count("*").alias("runs"))
    usual = votes.groupBy("column").agg(F.min_by("kind", F.struct(-F.col("runs"), "kind")).alias("usual"))
    other = kinds.join(usual, "column").where("kind <> usual").select(*run, "column", "kind", "usual", "files")
    # Columns that more than half of the runs have: at most as many as a file has columns.
    runs = schemas.select(*run).distinct().count()
    held = schemas.groupBy(*run, "column").agg(F.count_distinct("file").alias("_with"))
    often = held.groupBy("column").agg(F.count("*").alias("n")).where(F.col("n") * 2 > runs)
    names = F.array(*[F.lit(r["column"]) for r in often.collect()]).cast("array<string>")
    every = schemas.groupBy(*run).agg(F.count_distinct("file").alias("_files")).withColumn("column", F.explode(names))
    lacking = every.join(held, [*run, "column"], "left").join(usual, "column")
    lacking = lacking.withColumn("files", F.col("_files") - F.coalesce("_with", F.lit(0))).where("files > 0")
    return other.unionByName(lacking.select(*run, "column", F.lit(None).cast("string").alias("kind"), "usual", "files"))


def run_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Keys of the left table that the right one lacks, each once."""
    return left.subtract(right)
