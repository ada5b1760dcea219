"""Declared schemas. Nothing is inferred from files, so a column's type cannot change between runs."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def schema(text: str) -> T.StructType:
    """Schema from ``name type, name type``; needs no running session."""
    fields = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


SURVEY_HOUSEHOLDS = schema(
    "SERIALNO string, PUMA string, NP double, HINCP double, HHT string, HUPAC string, VEH string, BLD string, "
    "TYPEHUGQ int, WGTP double"
)
SURVEY_PERSONS = schema(
    "SERIALNO string, SPORDER double, PUMA string, AGEP double, SEX string, ESR string, COW string, WKHP double, "
    "SCHG string, HISP string, RAC1P string, MIL string, SCHL string, OCCP string, WKW string, NAICSP string, "
    "SOCP string, TYPEHUGQ int, PINCP double, PWGTP double"
)
GEO_CROSS_WALK = schema("mgra int, PUMA int, region int")
ECONOMIC_CONTROLS = schema(
    "region int, Control string, Label string, 2022 double, 2026 double, 2029 double, 2032 double, "
    "2035 double, 2040 double, 2050 double, 2060 double"
)
CONTROL_DEFINITIONS = schema(
    "target string, geography string, seed_table string, importance long, control_field string, expression string"
)
REPORTING_DEFINITIONS = schema(
    "target string, geography string, seed_table string, control_field string, population string, expression string"
)
SYNTHETIC_HOUSEHOLDS = schema(
    "household_id long, mgra int, SERIALNO string, NP double, HHADJINC double, HHT double, HUPAC double, VEH double, "
    "BLD double, gq_type int, workers int"
)
SYNTHETIC_PERSONS = schema(
    "household_id long, mgra int, SERIALNO string, SPORDER double, AGEP double, SEX int, ESR double, COW double, "
    "WKHP double, SCHG double, RAC1P string, HISP string, MIL double, SCHL double, OCCP double, WKW double, "
    "NAICSP string, NAICS2 string, SOCP string, SOC2 string"
)
BENCHMARK_COMPARISONS = schema(
    "target string, control_field string, geography string, id int, control_value double, result double"
)
TIMING_LOG = schema("model_name string, seconds double")
# Columns whose text must stay text when seeds are read from CSV.
SEED_TEXT_COLUMNS = ("SERIALNO", "NAICSP", "NAICS2", "SOCP")
