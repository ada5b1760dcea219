"""What each record contributes to each control, and counts of that by area."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecraft.definitions import Control
from zonecraft.operators import seed
from zonecraft.operators.keys import fail_if, one_row_per


def matched(control: Control) -> Column:
    return F.count_if(control.matches()).alias(control.target)


def of_table(controls: Iterable[Control], table: str) -> list[Control]:
    return [c for c in controls if c.seed_table == table]


def incidence(
    households: DataFrame,
    persons: DataFrame,
    controls: Sequence[Control],
    key: str | Sequence[str] = "hhid",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per household: 0/1 for each household control, the number of matching persons for each person control."""
    key = [key] if isinstance(key, str) else list(key)
    own = of_table(controls, "households")
    members = of_table(controls, "persons")
    flags = households.select(
        *key, *keep, *[F.coalesce(c.matches().cast("int"), F.lit(0)).alias(c.target) for c in own]
    )
    if not members:
        return flags
    counts = persons.groupBy(*key).agg(*[matched(c) for c in members])
    return flags.join(counts, key, "left").na.fill(0, [c.target for c in members])


def survey_incidence(
    households: DataFrame, persons: DataFrame, controls: Sequence[Control], keep: Sequence[str] = ()
) -> DataFrame:
    """``incidence`` of the seeds that survey tables make, keyed by SERIALNO, without building the person seed.

    Person controls are counted where the household seed rolls its persons up: persons are read and shuffled once, and only
    one row per household is joined. A household listed several times counts its persons as often, as a join of the two
    seeds does. Person controls may read the seed's columns except PUMA, which comes from the household.
    """
    own, members = of_table(controls, "households"), of_table(controls, "persons")
    counts = {f"_count_{k}": c for k, c in enumerate(members)}
    placed = seed.occupied(households)
    # As many rows as the survey lists a household: the join on SERIALNO brings them to one task anyway.
    placed = placed.withColumn("_copies", F.count("*").over(Window.partitionBy("SERIALNO")))
    # Persons are shuffled as they are: a partial sum per household would be the wider row where households are scattered.
    everyone = seed.classified(persons.where("SERIALNO is not null").repartition("SERIALNO"))
    found = [F.count_if(c.matches()).alias(name) for name, c in counts.items()]
    rows = seed.seed_households(placed, everyone, found, ["_copies", *counts])
    return rows.select(
        "SERIALNO",
        *keep,
        *[F.coalesce(c.matches().cast("int"), F.lit(0)).alias(c.target) for c in own],
        *[(F.col(name) * F.col("_copies")).alias(c.target) for name, c in counts.items()],
    )


def count_by(population: DataFrame, area: Sequence[str], controls: Sequence[Control]) -> DataFrame:
    """Matching records per area, one column per control, in one pass over the population."""
    return population.groupBy(*area).agg(*[matched(c) for c in controls])


def counts_long(population: DataFrame, area: Sequence[str], controls: Sequence[Control]) -> DataFrame:
    wide = count_by(population, area, controls)
    return wide.unpivot(list(area), [c.target for c in controls], "target", "result")


def with_puma(rows: DataFrame, crosswalk: DataFrame, zone: str = "id") -> DataFrame:
    """Add the zone's PUMA. A zone listed twice or not at all in the crosswalk fails the job."""
    lookup = one_row_per(crosswalk.select("mgra", "PUMA"), ["mgra"], "Crosswalk lists a zone more than once")
    puma = fail_if(F.col("PUMA").isNull(), "the crosswalk has no PUMA for a zone", F.col("PUMA"))
    return rows.join(lookup.withColumnRenamed("mgra", zone), zone, "left").withColumn("PUMA", puma)


def targets_of(totals: DataFrame, controls: Sequence[Control], keep: Sequence[str]) -> DataFrame:
    """A table of totals with one column per target, taken from the field that the control names."""
    return totals.select(*keep, *[F.col(c.field).cast("double").alias(c.target) for c in controls])


def puma_targets(controls: DataFrame, crosswalk: DataFrame, targets: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Targets per PUMA implied by the zone controls."""
    placed = with_puma(controls, crosswalk, "mgra")
    return placed.groupBy("PUMA", *keep).agg(*[F.sum(t).alias(t) for t in targets])


def hierarchy_totals(rows: DataFrame, crosswalk: DataFrame, values: Sequence[str]) -> DataFrame:
    """Zone, PUMA, region and grand totals in one aggregate; ``level`` names what a row is a total of."""
    placed = rows.join(crosswalk, "mgra")
    level = F.grouping_id("region", "PUMA", "mgra")
    names = F.when(level == 0, "mgra").when(level == 1, "PUMA").when(level == 3, "region").otherwise("all")
    return (
        placed.rollup("region", "PUMA", "mgra")
        .agg(names.alias("level"), *[F.sum(v).alias(v) for v in values])
        .select("level", "region", "PUMA", "mgra", *values)
    )


def signatures(incidence_rows: DataFrame, group: Sequence[str], targets: Sequence[str], weight: str = "WGTP") -> DataFrame:
    """Records of identical incidence merged: summed weight, record count, and the lowest record id as signature id."""
    return incidence_rows.groupBy(*group, *targets).agg(
        F.sum(weight).alias("w0"), F.count("*").alias("members"), F.min("hhid").alias("sig")
    )


def split_signatures(
    incidence_rows: DataFrame, weighted: DataFrame, group: Sequence[str], targets: Sequence[str], weight: str = "WGTP"
) -> DataFrame:
    """Hand a signature's new weight ``w`` back to its members in proportion to their old weights."""
    ratio = weighted.select(*group, *targets, (F.col("w") / F.col("w0")).alias("_ratio"))
    return (
        incidence_rows.join(ratio, [*group, *targets])
        .withColumn("w", F.col(weight) * F.col("_ratio"))
        .drop("_ratio")
    )
