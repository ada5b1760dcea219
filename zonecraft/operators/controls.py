"""Control totals from forecast tables, for all zones and all forecast years at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecraft.definitions import (
    AGE_BANDS,
    AGE_GROUP_IDS,
    ECONOMIC_LABELS,
    ETHNICITY_IDS,
    GQ_RUNS,
    INCOME_BANDS,
    INCOME_SOURCES,
    MGRABASE_COLUMNS,
)

ZONE_YEAR = ["mgra", "increment"]


def _plus(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def _sum_if(condition: Column, value: str, name: str) -> Column:
    return F.sum(F.when(condition, F.col(value)).otherwise(0)).alias(name)


def population_controls(population: DataFrame) -> DataFrame:
    """Household population by sex, age and race/ethnicity per zone and year."""
    sex, group, ethnicity = F.col("sex_id"), F.col("age_group_id"), F.col("ethnicity_id")
    return population.groupBy(*ZONE_YEAR).agg(
        F.sum("hhp").alias("Total_Pop"),
        _sum_if(sex == 2, "hhp", "Male"),
        _sum_if(sex == 1, "hhp", "Female"),
        *[
            _sum_if(group.between(first, last), "hhp", name)
            for (name, _, _), (first, last) in zip(AGE_BANDS, AGE_GROUP_IDS)
        ],
        *[_sum_if(ethnicity.isin(*ids), "hhp", name) for name, ids in ETHNICITY_IDS.items()],
    )


def household_controls(characteristics: DataFrame) -> DataFrame:
    """Households by size, workers and children per zone and year."""
    total = lambda *names: _plus([F.sum(n) for n in names])
    return characteristics.groupBy(*ZONE_YEAR).agg(
        total("hhs1").alias("HHSize_1"),
        total("hhs2").alias("HHSize_2"),
        total("hhs3").alias("HHSize_3"),
        total("hhs4", "hhs5", "hhs6", "hhs7").alias("HHSize_4Plus"),
        total(*[f"hhs{n}" for n in range(1, 8)]).alias("Total_HH"),
        total("hhworkers0").alias("HHWork_0"),
        total("hhworkers1").alias("HHWork_1"),
        total("hhworkers2").alias("HHWork_2"),
        total("hhworkers3").alias("HHWork_3Plus"),
        total("hhwoc").alias("HHChild_0"),
        total("hhwc").alias("HHChild_1Plus"),
    )


def income_and_gq_controls(mgrabase: DataFrame) -> DataFrame:
    """Households per income band and group-quarters population by type."""
    return mgrabase.select(
        *ZONE_YEAR,
        *[
            _plus([F.col(f"i{k}") for k in sources]).alias(name)
            for (name, _, _), sources in zip(INCOME_BANDS, INCOME_SOURCES)
        ],
        F.col("gq_civ_college").alias("gq_college_pop"),
        F.col("gq_mil").alias("gq_mil_pop"),
        F.col("gq_civ_other").alias("gq_other_pop"),
    )


def with_total_hh_gq(controls: DataFrame) -> DataFrame:
    return controls.withColumn(
        "Total_HH_GQ", _plus([F.col(c) for c in ("Total_HH", "gq_college_pop", "gq_mil_pop", "gq_other_pop")])
    )


def zone_controls(population: DataFrame, characteristics: DataFrame, mgrabase: DataFrame) -> DataFrame:
    """All zone controls; a zone missing from any of the three inputs is left out."""
    joined = (
        population_controls(population)
        .join(household_controls(characteristics), ZONE_YEAR)
        .join(income_and_gq_controls(mgrabase), ZONE_YEAR)
    )
    return with_total_hh_gq(joined)


def land_use_output(mgrabase: DataFrame) -> DataFrame:
    """The 62 land-use columns handed on to the travel model, per year."""
    source = {"emp_total": "emp_tot"}
    return mgrabase.select("increment", *[F.col(source.get(c, c)).alias(c) for c in MGRABASE_COLUMNS])


def gq_controls(controls: DataFrame) -> DataFrame:
    """Zone totals per group-quarters run, long; zones without that population are left out."""
    long = controls.unpivot(ZONE_YEAR, [pop for _, _, pop, _, _ in GQ_RUNS], "_column", "Total_GQ")
    pick = lambda at: reduce(lambda chain, run: chain.when(F.col("_column") == run[2], run[at]), GQ_RUNS, F)
    return long.where("Total_GQ > 0").select(
        *ZONE_YEAR, pick(0).alias("synthesis_run"), pick(3).alias("control_field"), "Total_GQ"
    )


def regional_military(mgrabase: DataFrame) -> DataFrame:
    return mgrabase.groupBy("increment").agg(F.sum("gq_mil").alias("gq_mil"))


def economic_long(economic: DataFrame, years: list[int]) -> DataFrame:
    """Economic totals with one row per year; rows without a label drop out."""
    labelled = economic.where(F.col("Label").isNotNull())
    long = labelled.unpivot(["region", "Label"], [str(y) for y in years], "year", "value")
    return long.withColumn("year", F.col("year").cast("int"))


def economic_controls(economic: DataFrame, years: list[int]) -> DataFrame:
    """Economic totals summed per region, year and label, one column per label."""
    return (
        economic_long(economic, years).groupBy("region", "year").pivot("Label", ECONOMIC_LABELS).agg(F.sum("value"))
    )


def region_controls(economic: DataFrame, mgrabase: DataFrame, years: list[int]) -> DataFrame:
    """Labour-force totals with the group-quarters military taken out of the military sector."""
    military = regional_military(mgrabase).withColumnRenamed("increment", "year")
    return (
        economic_controls(economic, years)
        .join(military, "year", "left")
        .withColumn("job_2", F.col("job_2") - F.col("gq_mil"))
        .select("region", "year", *ECONOMIC_LABELS)
    )
