"""From weights to records: replicas, ids, and the merged household and person tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecraft.definitions import HOUSEHOLD_COLUMNS, PERSON_COLUMNS, RUN_ORDER
from zonecraft.operators.raking import apportion
from zonecraft.operators.running import running_total

CHUNK = 10_000


def expand(rows: DataFrame, weight: str, into: str = "replica", chunk: int = CHUNK) -> DataFrame:
    """One row per unit of weight, numbered from 0. A heavy row is cut into chunks that different tasks unfold."""
    columns = rows.columns
    size = F.col(weight)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = rows.where(size > 0).withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((size - 1) / chunk).cast("int"))))
    spread = pieces.repartition(tasks, F.xxhash64(*columns), "_chunk")
    first = F.col("_chunk").cast("long") * chunk
    last = F.least(first + chunk, size.cast("long")) - 1
    return spread.select(*columns, F.explode(F.sequence(first, last)).alias(into))


def replica_starts(
    weights: DataFrame, order: Sequence[str], weight: str = "integer_weight", group: Sequence[str] = ()
) -> DataFrame:
    """Add ``start``: how many replicas come before this row's in the given order, per group."""
    return running_total(weights, list(group), list(order), weight, "start")


def replica_ids(expanded: DataFrame) -> DataFrame:
    """Consecutive household ids from 1, from the row's start and the replica number."""
    return expanded.withColumn("household_id", F.col("start") + F.col("replica") + 1).drop("start", "replica")


def expand_households(weights: DataFrame, order: Sequence[str] = ("mgra", "hhid")) -> DataFrame:
    return replica_ids(expand(replica_starts(weights, order), "integer_weight"))


def expand_records(starts: DataFrame, records: DataFrame, key: Sequence[str] = ("hhid",)) -> DataFrame:
    """All records (household attributes or persons) of every replica. Records are joined to the weights first, so a
    popular household is joined once per zone, not once per replica; its replicas are unfolded by many tasks."""
    return replica_ids(expand(starts.join(records, list(key)), "integer_weight"))


def expand_persons(weights: DataFrame, persons: DataFrame, order: Sequence[str] = ("mgra", "hhid")) -> DataFrame:
    return expand_records(replica_starts(weights, order), persons)


def fill_zones(
    slots: DataFrame, members: DataFrame, pool: Sequence[str], zone: str = "mgra", order: str | None = None
) -> DataFrame:
    """Fill each zone's slots with households of its pool, each household used in proportion to its weight.

    ``slots``: pool keys, zone, ``n``. ``members``: pool keys, hhid, ``w``. Both are whole numbers. Both sides of a pool are laid out
    as the same run of units and joined on the unit, so the work is the size of the result. Returns one row per unit.
    """
    pool = list(pool)
    wanted = slots.where("n > 0")
    totals = wanted.groupBy(*pool).agg(F.sum("n").alias("total"))
    quota = apportion(members.select(*pool, "hhid", "w"), totals, pool, "w", "hhid").where("integer_weight > 0")
    place = F.xxhash64("hhid") if order is None else F.col(order)
    layout = quota.select(*pool, "hhid", "integer_weight", place.alias("_place"))
    seats = running_total(layout, pool, ["_place", "hhid"], "integer_weight", "_start")
    rows = running_total(wanted.select(*pool, zone, "n"), pool, [zone], "n", "_start")
    unit = (F.col("_start") + F.col("_unit")).alias("unit")
    taken = expand(seats, "integer_weight", "_unit").select(*pool, unit, "hhid")
    open_slots = expand(rows, "n", "_unit").select(*pool, unit, zone)
    return open_slots.join(taken, [*pool, "unit"])


def zone_weights(filled: DataFrame, zone: str = "mgra", keep: Sequence[str] = ()) -> DataFrame:
    return filled.groupBy(*keep, zone, "hhid").agg(F.count("*").alias("integer_weight"))


# --- merging runs ------------------------------------------------------------------------------------------------


def run_offsets(
    rows: DataFrame, size: Column | None = None, order: Sequence[str] = RUN_ORDER, keep: Sequence[str] = ()
) -> DataFrame:
    """Households of all runs before this one, in the configured order. One row per run type (and year).

    ``size`` counts the households of a run where a row is not one household.
    """
    rank = F.array_position(F.array(*[F.lit(r) for r in order]), F.col("synthesis_run"))
    counts = rows.groupBy(*keep, "synthesis_run").agg((F.count("*") if size is None else size).alias("n"))
    before = Window.partitionBy(*keep).orderBy(rank).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*keep, "synthesis_run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))


def offset_ids(rows: DataFrame, offsets: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Shift each run's ids behind those of the runs before it. ``offsets`` has one row per run type (and year)."""
    return (
        rows.join(offsets, [*keep, "synthesis_run"])
        .withColumn("household_id", F.col("household_id") + F.col("offset"))
        .drop("offset")
    )


def stack_runs(runs: dict[str, DataFrame]) -> DataFrame:
    tagged = [df.withColumn("synthesis_run", F.lit(name)) for name, df in runs.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def merged_households(households: DataFrame) -> DataFrame:
    """Defaults of the merged table: no negative income, unknown codes 0, the PUMA dropped."""
    income = F.when(F.col("HHADJINC") < 0, 0).otherwise(F.col("HHADJINC"))
    return households.drop("PUMA").withColumn("HHADJINC", income).na.fill(0, ["HHT", "HUPAC", "BLD"])


def merged_persons(persons: DataFrame) -> DataFrame:
    codes = ["ESR", "COW", "WKHP", "SCHG", "MIL", "SCHL", "OCCP", "WKW"]
    return persons.drop("PUMA").na.fill(0, codes).na.fill("0", codes)


def household_output(households: DataFrame) -> DataFrame:
    return households.select("household_id", "mgra", "PUMA", *HOUSEHOLD_COLUMNS)


def person_output(persons: DataFrame) -> DataFrame:
    return persons.select("household_id", "mgra", "PUMA", *PERSON_COLUMNS)
