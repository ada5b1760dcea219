"""Column functions for control-versus-result reports and published text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Report categories. Kind of match, pattern(s), category; the first match wins.
LOCAL_CATEGORIES = [
    ("is", ("Total_HH",), "Households"),
    ("starts", ("HHSize_",), "Household Size"),
    ("starts", ("HHInc_",), "Household Income"),
    ("starts", ("HHWork_",), "Household Workers"),
    ("starts", ("HHChild_",), "Household Children"),
    ("is", ("Male", "Female"), "Sex"),
    ("is", ("Total_Pop",), "Household Population"),
    ("starts", ("Age_",), "Age"),
    ("is", ("Asian", "Black", "Hispanic", "Other", "Two_or_more", "White"), "Race/Ethnicity"),
    ("starts", ("job_",), "Labor Force"),
    ("starts", ("lfp_",), "Civilian Labor Force"),
    ("is", ("Total_GQ",), "Group Quarters"),
    ("starts", ("GQ_",), "Group Quarters"),
]
# The database report's patterns, where `_` matches any character and case is ignored.
SQL_CATEGORIES = [
    ("like", ("Total_HH",), "Households"),
    ("like", ("HHSize_%",), "Household Size"),
    ("like", ("HHInc_%",), "Household Income"),
    ("like", ("HHWork__%",), "Household Workers"),
    ("like", ("HHChild_%",), "Household Children"),
    ("is", ("Male", "Female"), "Sex"),
    ("like", ("Age_%",), "Age"),
    ("is", ("Asian", "Black", "Hispanic", "Other", "Two_or_more", "White"), "Race/Ethnicity"),
    ("like", ("job_%",), "Labor Force"),
    ("like", ("lfp_%",), "Civilian Labor Force"),
    ("like", ("gq__%",), "Group Quarters"),
]

FITTING = "Fitting Control"
BENCHMARK = "Benchmark Only"


def _categorize(field: Column, rules: list) -> Column:
    tests = {
        "is": lambda values: field.isin(*values),
        "starts": lambda values: field.startswith(values[0]),
        "like": lambda values: field.ilike(values[0]),
    }
    return reduce(lambda chain, rule: chain.when(tests[rule[0]](rule[1]), rule[2]), rules, F)


def category_local(field: Column) -> Column:
    """Category of a control field; "Uncategorized" without a field, NULL for a field of no category."""
    return F.when(field.isNull(), "Uncategorized").otherwise(_categorize(field, LOCAL_CATEGORIES))


def category_sql(field: Column) -> Column:
    return _categorize(field, SQL_CATEGORIES)


def diff(control: Column, result: Column) -> Column:
    return result - control


def diff_pct(control: Column, result: Column) -> Column:
    """Percent difference with two decimals; 0 if equal, NULL if there is nothing to compare with."""
    return (
        F.when(control.isNull() | result.isNull(), F.lit(None).cast("double"))
        .when(control == result, 0.0)
        .when(control == 0, F.lit(None).cast("double"))
        .otherwise(F.round(100.0 * (result - control) / control, 2))
    )


def half_even(value: Column, digits: int = 2) -> Column:
    """Half-to-even rounding on the binary value, as the reporting statistics use."""
    return F.rint(value * 10**digits) / 10**digits


def clean_numeric_text(text: Column) -> Column:
    """Empty text is NULL; a whole number written as a decimal loses its ``.0``."""
    return F.regexp_replace(F.nullif(text, F.lit("")), r"\.0$", "")


def lake_name(name: Column) -> Column:
    """Table name in the lake: one table carries its year in the file name, which is taken off."""
    return F.regexp_replace(name, r"^(mgra15_based_input)_\d{4}$", "$1")


def display_year(run: Column) -> Column:
    """Leading four digits of a run name, else the whole name."""
    return F.coalesce(F.nullif(F.regexp_extract(run, r"^(\d{4})", 1), F.lit("")), run)


def timestamp_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")
