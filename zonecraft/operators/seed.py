"""Seed households and persons from survey microdata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecraft.functions import seed as fn
from zonecraft.operators.running import number_rows

PERSON_COLUMNS = [
    "SERIALNO",
    "SPORDER",
    "PUMA",
    "AGEP",
    "SEX",
    "ESR",
    "laborforce",
    "worker",
    "COW",
    "WKHP",
    "SCHG",
    "HISP",
    "RAC1P",
    "race",
    "MIL",
    "SCHL",
    "OCCP",
    "WKW",
    "NAICSP",
    "NAICS2",
    "SOCP",
    "SOC2",
    "TYPEHUGQ",
    "gq_type",
    "PINCP",
]
SURVEY_COLUMNS = [c for c in PERSON_COLUMNS if c not in ("PUMA", "laborforce", "worker", "race", "NAICS2", "SOC2", "gq_type")]


def person_rollup(persons: DataFrame, counts: Sequence[Column] = ()) -> DataFrame:
    """Per household: workers, and the highest value of the codes that classify single-person group quarters.

    ``counts``: aggregates over a household's persons that are made in the same pass.
    """
    return persons.groupBy("SERIALNO").agg(
        F.sum(fn.is_worker(F.col("ESR"))).alias("workers"),
        *[F.max(c).alias(c) for c in ("MIL", "SCHG", "PWGTP", "PINCP")],
        *counts,
    )


def occupied(households: DataFrame) -> DataFrame:
    return households.where("NP > 0")


def households_with_persons(households: DataFrame, persons: DataFrame, counts: Sequence[Column] = ()) -> DataFrame:
    """Occupied households joined with their person roll-up; households without a person drop out."""
    return occupied(households).join(person_rollup(persons, counts), "SERIALNO")


def seed_households(
    households: DataFrame, persons: DataFrame, counts: Sequence[Column] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """``counts``: further aggregates of the person roll-up; ``keep`` names those and household columns to carry along."""
    typehugq = F.col("TYPEHUGQ")
    income = F.when(fn.is_group_quarters(typehugq), F.col("PINCP")).otherwise(F.col("HINCP"))
    return households_with_persons(households, persons, counts).select(
        "SERIALNO",
        "PUMA",
        "NP",
        "HINCP",
        fn.adjust_income(income, F.col("SERIALNO")).alias("HHADJINC"),
        "HHT",
        "workers",
        "HUPAC",
        "VEH",
        "BLD",
        "TYPEHUGQ",
        fn.gq_type(typehugq, F.col("MIL"), F.col("SCHG")).alias("gq_type"),
        fn.seed_weight(typehugq, F.col("WGTP"), F.col("PWGTP")).alias("WGTP"),
        *keep,
    )


def persons_in_occupied(persons: DataFrame, households: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Persons of occupied households; ``keep`` names household columns to carry along."""
    parents = occupied(households).select("SERIALNO", *keep)
    return persons.join(parents, "SERIALNO", "inner" if keep else "left_semi")


def classified(persons: DataFrame) -> DataFrame:
    """Persons with the columns that a seed person has beside the survey's own."""
    c = F.col
    return persons.withColumns(
        {
            "laborforce": fn.in_labor_force(c("ESR")),
            "worker": fn.is_worker(c("ESR")),
            "SCHG": F.coalesce(c("SCHG"), F.lit(0)),
            "race": fn.race(c("HISP"), c("RAC1P")),
            "NAICS2": fn.industry_sector(c("NAICSP")),
            "SOC2": fn.occupation_group(c("SOCP")),
            "gq_type": fn.gq_type(c("TYPEHUGQ"), c("MIL"), c("SCHG")),
        }
    )


def seed_persons(persons: DataFrame, households: DataFrame) -> DataFrame:
    return classified(persons_in_occupied(persons, households, keep=("PUMA",))).select(*PERSON_COLUMNS)


def seed_parents(households: DataFrame, seeds: DataFrame) -> DataFrame:
    """What seed persons take from their households: PUMA, number and run.

    ``seeds``: numbered households with their runs. A household listed several times has as many rows for each of its rows in
    either table, so persons come as often as after joins with one and then the other.
    """
    return occupied(households).select("SERIALNO", "PUMA").join(seeds.select("SERIALNO", "is_gq", "hhid", "synthesis_run"), "SERIALNO")


def persons_of_seed(persons: DataFrame, parents: DataFrame) -> DataFrame:
    """The survey's persons that belong to seed households, joined once; ``seed_columns`` completes them."""
    return mark_group_quarters(persons.select(*SURVEY_COLUMNS)).join(parents, ["is_gq", "SERIALNO"])


def seed_columns(persons: DataFrame) -> DataFrame:
    """Rows of ``persons_of_seed`` with the columns of ``seed_persons``."""
    return classified(persons).select("is_gq", "hhid", *PERSON_COLUMNS, "synthesis_run")


def mark_group_quarters(df: DataFrame) -> DataFrame:
    """Split into households and group quarters by a column; records of neither kind drop out."""
    typehugq = F.col("TYPEHUGQ")
    return df.where(typehugq.isin(1, 2, 3)).withColumn("is_gq", fn.is_group_quarters(typehugq))


def split_runs(households: DataFrame) -> DataFrame:
    """Assign each seed household to its synthesis run; records without a type drop out."""
    return households.withColumn("synthesis_run", fn.synthesis_run(F.col("gq_type"))).where(
        F.col("synthesis_run").isNotNull()
    )


def persons_of(persons: DataFrame, households: DataFrame, key: str = "hhid") -> DataFrame:
    return persons.join(households.select(key), key, "left_semi")


def household_numbers(households: DataFrame) -> DataFrame:
    keys = mark_group_quarters(households).select("is_gq", "SERIALNO").distinct()
    return number_rows(keys, ["is_gq"], ["SERIALNO"], "hhid")


def numbered_households(households: DataFrame) -> DataFrame:
    return mark_group_quarters(households).join(household_numbers(households), ["is_gq", "SERIALNO"])


def assign_hhid(households: DataFrame, persons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Number households 1..n by SERIALNO, separately for households and group quarters.

    The number is made once on the household keys and joined to the persons, so both tables always agree.
    """
    numbered = household_numbers(households)
    return (
        mark_group_quarters(households).join(numbered, ["is_gq", "SERIALNO"]),
        mark_group_quarters(persons).join(numbered, ["is_gq", "SERIALNO"]),
    )


def sorted_output(df: DataFrame, *order: str) -> DataFrame:
    """Order for a sink: range partitions, each sorted, so files read in sequence are in order."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def empty_runs(households: DataFrame) -> DataFrame:
    """Rows per run, with runs that have no seed household marked."""
    from zonecraft.definitions import RUN_ORDER

    spark = households.sparkSession
    expected = spark.createDataFrame([(r,) for r in RUN_ORDER], "synthesis_run string")
    counted = households.groupBy("synthesis_run").agg(F.count("*").alias("n"))
    return expected.join(counted, "synthesis_run", "left").select(
        "synthesis_run", F.coalesce("n", F.lit(0)).alias("n"), F.col("n").isNull().alias("is_empty")
    )


def distinct_profile(df: DataFrame, columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Group, ``column``, ``rows``, ``nulls`` and the exact number of ``distinct`` values."""
    group = list(group)
    # One row per value: a hot value is combined before the shuffle, and no task holds a column's values.
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(*group, F.inline(entries)).groupBy(*group, "column", "value").agg(F.count("*").alias("n"))
    return values.groupBy(*group, "column").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
        F.count("value").alias("distinct"),
    )


SKETCH_BITS = 14  # 12 KB a sketch; the estimate is within 2 per cent in 19 of 20 columns


def sketch_profile(df: DataFrame, columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Group, ``column``, ``rows``, ``nulls`` and a ``sketch`` of the distinct values, to be stored with a run."""
    group = list(group)
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(*group, F.inline(entries))
    return values.groupBy(*group, "column").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("value").isNull()).alias("nulls"),
        F.hll_sketch_agg("value", SKETCH_BITS).alias("sketch"),
    )


def merged_profile(sketches: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Stored profiles of several runs as one, without reading the runs again; ``distinct`` is an estimate."""
    group = list(group)
    merged = sketches.groupBy(*group, "column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.hll_union_agg("sketch").alias("_all")
    )
    return merged.withColumn("distinct", F.hll_sketch_estimate("_all")).drop("_all")
