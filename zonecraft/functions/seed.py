"""Column functions that classify survey records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Regional consumer price index per survey year, and the index incomes are adjusted to.
CPI = {"2017": 283.012, "2018": 292.547, "2019": 299.433, "2020": 303.932, "2021": 319.761}
CPI_BASE = 344.416

# Race label per RAC1P code.
RACE_BY_CODE = {
    "1": "White alone",
    "2": "Black or African American alone",
    "3": "Other",
    "4": "Other",
    "5": "Other",
    "6": "Asian alone",
    "7": "Other",
    "8": "Other",
    "9": "Two or More Races",
}


def _lookup(key: Column, values: dict) -> Column:
    """Value for a key as a CASE chain (stays in codegen); NULL for an unknown key."""
    return reduce(lambda chain, kv: chain.when(key == kv[0], kv[1]), values.items(), F)


def is_group_quarters(typehugq: Column) -> Column:
    return typehugq.isin(2, 3)


def adjust_income(income: Column, serialno: Column, cpi: dict = CPI, base: float = CPI_BASE) -> Column:
    """Income in base-year money, rounded to whole units. A record of an unknown survey year is an error."""
    year = F.left(serialno, F.lit(4))
    index = _lookup(year, cpi)
    unknown = F.raise_error(F.concat(F.lit("No price index for survey year "), year)).cast("double")
    return F.when(index.isNull(), unknown).otherwise(F.round(income * base / index, 0))


def gq_type(typehugq: Column, mil: Column, schg: Column) -> Column:
    """0 housing unit, 1 military, 2 college, 3 other group quarters, else NULL. The first match wins."""
    return (
        F.when(typehugq == 1, 0)
        .when((typehugq == 3) & (mil == 1), 1)
        .when((typehugq == 3) & schg.isin(15, 16), 2)
        .when(is_group_quarters(typehugq), 3)
    )


def seed_weight(typehugq: Column, household_weight: Column, person_weight: Column) -> Column:
    return F.when(typehugq == 1, household_weight).when(is_group_quarters(typehugq), person_weight)


def in_labor_force(esr: Column) -> Column:
    return F.when(esr.isin(1, 2, 3, 4, 5), 1).otherwise(0)


def is_worker(esr: Column) -> Column:
    return F.when(esr.isin(1, 2, 4, 5), 1).otherwise(0)


def race(hispanic: Column, race_code: Column) -> Column:
    """Hispanic origin takes precedence over race; an unknown origin falls through to the race code."""
    return F.when(hispanic != "01", "Hispanic").otherwise(_lookup(race_code, RACE_BY_CODE))


def race_from_numbers(hispanic: Column, race_code: Column) -> Column:
    """As ``race`` for finished records whose codes may be written as numbers. Text that is no number is an error."""
    origin = hispanic.cast("int")
    return F.when(origin.isNotNull() & (origin != 1), "Hispanic").otherwise(
        _lookup(race_code.cast("int").cast("string"), RACE_BY_CODE)
    )


def labor_force_from_numbers(esr: Column) -> Column:
    return F.when(esr.cast("int").isin(1, 2, 3, 4, 5), 1).otherwise(0)


def industry_sector(naics: Column) -> Column:
    """Two-digit sector, three digits for accommodation and food, MIL for the armed forces."""
    return (
        F.when(F.left(naics, F.lit(4)) == "9281", "MIL")
        .when(F.left(naics, F.lit(2)) == "72", F.left(naics, F.lit(3)))
        .otherwise(F.left(naics, F.lit(2)))
    )


def occupation_group(soc: Column) -> Column:
    return F.left(soc, F.lit(2))


def synthesis_run(gq: Column) -> Column:
    """Run that a record of a group-quarters type belongs to."""
    from zonecraft.definitions import GQ_RUNS

    names = {0: "household", **{code: name for name, code, *_ in GQ_RUNS}}
    return _lookup(gq, names)
