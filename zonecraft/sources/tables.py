"""Scans. Filters and column lists reach the Parquet reader; forecast years are a filter, not a loop."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecraft.conditions import BadCondition, to_sql
from zonecraft.definitions import Control, checked_controls


def open_table(spark: SparkSession, source: str) -> DataFrame:
    """A Parquet path (anything with a slash) or a catalog table name."""
    return spark.read.parquet(source) if "/" in source else spark.read.table(source)


def forecast_source(schema: str, table: str) -> str:
    """Location of a forecast table: ``schema`` is a folder or a catalog namespace, with or without brackets."""
    namespace = schema.removeprefix("[").removesuffix("]")
    return f"{namespace.rstrip('/')}/{table}" if "/" in namespace else f"`{namespace}`.`{table}`"


def for_year(df: DataFrame, year: int) -> DataFrame:
    return df.where(F.col("increment") == year)


def for_years(df: DataFrame, years: Iterable[int]) -> DataFrame:
    return df.where(F.col("increment").isin(*years))


def read_forecast(spark: SparkSession, table: str, schema: str, year: int) -> DataFrame:
    return for_year(open_table(spark, forecast_source(schema, table)), year)


def read_forecast_years(spark: SparkSession, table: str, schema: str, years: Iterable[int]) -> DataFrame:
    return for_years(open_table(spark, forecast_source(schema, table)), years)


def read_forecast_jdbc(
    spark: SparkSession, url: str, table: str, year: int, zones: tuple[int, int], partitions: int, **options: str
) -> DataFrame:
    """Parallel database scan, split on the zone number."""
    reader = spark.read.format("jdbc").options(
        url=url,
        dbtable=table,
        partitionColumn="mgra",
        lowerBound=str(zones[0]),
        upperBound=str(zones[1]),
        numPartitions=str(partitions),
        **options,
    )
    return for_year(reader.load(), year)


def read_microdata(spark: SparkSession, view: str, columns: Iterable[str] | None = None) -> DataFrame:
    df = open_table(spark, view)
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with a declared schema; a row that does not fit it fails the job."""
    return spark.read.csv(path, schema=schema, header=True, mode="FAILFAST", enforceSchema=False)


def pin_types(schema: T.StructType, text: Iterable[str] = (), measures: Iterable[str] = ()) -> T.StructType:
    """The schema with some columns pinned to text and some to double, whatever a file looks like."""
    pinned = {**dict.fromkeys(text, T.StringType()), **dict.fromkeys(measures, T.DoubleType())}
    return T.StructType([T.StructField(f.name, pinned.get(f.name, f.dataType), True) for f in schema])


def read_controls(spark: SparkSession, path: str) -> list[Control]:
    """Control definitions from a CSV of a user's own: a configuration file of some dozens of lines, so it is read whole.

    Columns target, geography and seed_table are needed, and either expression (a condition over data frames, such as
    ``(households.NP >= 4) & (households.WGTP < np.inf)``) or predicate (Spark SQL over that table); importance, control_field
    and population may be empty or missing.
    """
    rows = [r.asDict() for r in spark.read.csv(path, header=True, mode="FAILFAST").collect()]
    found = []
    for n, row in enumerate(rows, 2):
        missing = [c for c in ("target", "geography", "seed_table") if not row.get(c)]
        if missing or not (row.get("expression") or row.get("predicate")):
            raise ValueError(f"{path}, line {n}: no {', '.join(missing) or 'expression or predicate'}")
        text = row.get("expression")
        try:
            predicate = to_sql(text, row["seed_table"]) if text else row["predicate"]
        except BadCondition as error:
            raise ValueError(f"{path}, line {n}, target {row['target']}: {error}") from error
        importance = row.get("importance")
        found.append(
            Control(
                row["target"],
                row["geography"],
                row["seed_table"],
                int(float(importance)) if importance else None,
                predicate,
                row.get("control_field"),
                row.get("population"),
            )
        )
    return checked_controls(found)
