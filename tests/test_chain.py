"""Seeds to published run on the smallest tables."""

import pytest
from pyspark.sql import functions as F

import suite.catalog  # noqa: F401
from suite.control_queries import YEARS
from suite.registry import QUERIES
from suite.standins import standin
from zonecraft import definitions as d
from zonecraft.functions.report import BENCHMARK, FITTING
from zonecraft.operators import fitting, quality, subzones
from zonecraft.plans import publication, synthesis, validation
from zonecraft.session import new_stage_path
from zonecraft.sources import publish, runs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def result(spark):
    table = lambda name: standin(spark, SF, name)
    seeds = synthesis.build_seeds(table("household_src"), table("person_src"))
    forecast = [table(n) for n in ("pop_ase_mgra", "hh_characteristics_mgra", "mgrabase", "economic_controls")]
    controls = synthesis.build_controls(*forecast, [2022, 2024])
    settings = synthesis.Settings(sweeps=1, zone_sweeps=20, accept_open=True, margins=("workers", "size", "sex", "total"))
    return synthesis.synthesize(seeds, controls, table("geo_cross_walk"), settings)


def test_the_chain_query_makes_all_years_and_sweeps_until_settled(spark, monkeypatch):
    class Enough(Exception):
        pass

    def seen(seeds, controls, crosswalk, settings=None):
        assert {r.increment for r in controls.zones.select("increment").distinct().collect()} == set(YEARS)
        assert {r.increment for r in controls.region.select("increment").distinct().collect()} == set(YEARS)
        whole, used = synthesis.Settings(), settings or synthesis.Settings()
        assert (used.sweeps, used.zone_sweeps, used.controls, used.margins) == (whole.sweeps, whole.zone_sweeps, None, None)
        raise Enough

    monkeypatch.setattr(synthesis, "build_seeds", lambda households, persons: None)
    monkeypatch.setattr(synthesis, "synthesize", seen)
    with pytest.raises(Enough):
        QUERIES["y16_synthesis_chain"](spark, SF)


def test_open_zones_stop_the_job_unless_accepted(spark, result):
    ended = {r.stage: r for r in result.convergence.collect()}
    assert set(ended) == {"seed", "seed with regional targets", "zones"} and ended["seed"].open > 0
    strict = synthesis.Settings(sweeps=1, margins=("workers", "total"))
    with pytest.raises(synthesis.NotConverged, match="seed: .* zones open after 1 sweeps"):
        synthesis.seed_weights(result.seeds, result.controls, standin(spark, SF, "geo_cross_walk"), strict)


def seed_shuffles(frame):
    """Exchanges by the household key above a scan of a bucketed seed table."""
    import re

    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    return [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\(synthesis_run", line)]


def test_seed_tables_are_joined_and_grouped_without_a_shuffle(spark, result):
    from zonecraft.operators import expand, incidence

    seeds, key = result.seeds, synthesis.SEED
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = incidence.incidence(seeds.households, seeds.persons, d.fitting_controls(), key, ("PUMA", "WGTP"))
        assert seed_shuffles(rows) == [] and rows.count() == seeds.households.count()
        starts = result.weights.withColumn("start", F.lit(0)).select(*key, "mgra", "start", "integer_weight")
        # Only the weights are dealt anew, not the seed.
        assert len(seed_shuffles(starts.join(seeds.persons.select(*key, "AGEP"), key))) == 1
        assert expand.expand_records(starts, seeds.persons.select(*key, "AGEP"), key).count() == result.persons.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ids_are_one_to_n_per_year_and_runs_are_pure(result):
    rows = result.households
    seen = rows.groupBy("increment").agg(F.min("household_id"), F.max("household_id"), F.count_distinct("household_id"), F.count("*"))
    for r in seen.collect():
        assert r[1] == 1 and r[2] == r[3] == r[4]
    checked = quality.merged_population_check(rows.where("increment = 2022")).collect()
    assert all(r.repeated_ids == 0 and r.wrong_type == 0 for r in checked)


def test_every_household_brings_all_its_persons(result):
    seed_sizes = result.seeds.persons.groupBy("synthesis_run", "hhid").count()
    expected = result.weights.join(seed_sizes, ["synthesis_run", "hhid"]).agg(F.sum(F.col("integer_weight") * F.col("count"))).first()[0]
    assert result.persons.count() == expected
    assert quality.orphans(result.persons, result.households, "household_id").count() == 0


def test_zones_are_rounded_beside_their_cells_as_by_rows_of_zone_and_cell(spark, result, monkeypatch):
    settings = synthesis.Settings(sweeps=1, zone_sweeps=20, accept_open=True, margins=("workers", "size", "sex", "total"))
    crosswalk = standin(spark, SF, "geo_cross_walk")
    _, cells, state = synthesis.zone_cells(result.seed_weights, result.controls.zones, crosswalk, settings)
    made, stage = [], synthesis.stage
    monkeypatch.setattr(synthesis, "stage", lambda df, name: made.append(name) or stage(df, name))
    monkeypatch.setattr(subzones, "TOGETHER", 5)
    found = {}
    for near in (fitting.NEAR, 0):
        monkeypatch.setattr(fitting, "NEAR", near)
        slots, sums, lost = synthesis.rounded_cells(cells, state, settings)
        found[near] = (
            {(r.increment, r.mgra, r.pool, r.cell): r.n for r in slots.collect()},
            {(r.increment, r.pool, r.cell): r.w for r in sums.collect()},
            {(r.increment, r.mgra) for r in lost.collect()},
        )
        # Only the other way writes a row per zone and cell.
        assert ("cell-weights" in made) == (near == 0)
    (slots, sums, lost), (other_slots, other_sums, other_lost) = found.values()
    assert slots == other_slots and lost == other_lost and sums == pytest.approx(other_sums)
    homes = {(r.increment, r.mgra): r.homes for r in state.where("homes > 0").collect()}
    made = dict.fromkeys(homes, 0)
    for (increment, mgra, _, _), n in slots.items():
        made[increment, mgra] += n
    assert made == homes and lost


def test_report_covers_all_kinds_of_controls(spark, result):
    of_year = lambda df: df.where("increment = 2022").drop("increment")
    report = validation.control_report(
        of_year(result.households),
        of_year(result.persons),
        of_year(result.controls.zones),
        of_year(result.controls.quarters),
        standin(spark, SF, "geo_cross_walk"),
        of_year(result.region_summary),
    )
    rows = report.collect()
    # The region's rows of the zone controls are in the summary too, so every fitted control is reported for the region.
    assert {c.field for c in d.fitting_controls()} <= {r["Control Field"] for r in rows if r.geography == "region"}
    assert {r.Status for r in rows} == {FITTING, BENCHMARK}
    assert {r.geography for r in rows} == {"mgra", "puma", "region"}
    totals = [r for r in rows if r["Control Field"] == "Total_HH" and r.geography == "mgra"]
    assert totals and all(r.Diff == 0 for r in totals)
    quarters = [r for r in rows if r.Category == "Group Quarters"]
    assert quarters and all(r.Diff == 0 for r in quarters)


def test_region_summary_holds_all_stages(result):
    rows = {r.control_name: r for r in result.region_summary.where("increment = 2022").collect()}
    assert set(rows) == {c.target for c in d.fitting_controls()}
    total = rows["Total_HH"]
    assert total.mgra_integer_weight == total.control_value == pytest.approx(total.mgra_balanced_weight)
    assert total.region_preliminary_balanced_weight > 0 and total.region_balanced_weight > 0


def test_published_run_is_complete_and_readable(spark, result):
    root = new_stage_path(spark, "lake")
    tables = publication.run_tables(result, 2022, standin(spark, SF, "geo_cross_walk"), standin(spark, SF, "mgrabase_wide"))
    assert {"controls", "reporting_controls", "benchmark_comparisons", "mgra15_based_input", "final_summary_region_1"} <= set(tables)
    assert {"final_summary_mgra", "final_summary_mgra_puma"} <= set(tables)
    written = publication.publish_run(spark, tables, root, 2022, "2026-01-02 03:04:05", {"version": "1"}, "b", "me")
    markers = spark.read.schema(publish.MARKER_SCHEMA).parquet(f"{root}/{publish.MARKERS}")
    marker = markers.first()
    assert sorted(written) == marker.files and marker.succeeded == len(written)
    people = spark.read.parquet(f"{root}/synthetic_persons")
    assert runs.read_completed(people, markers).count() == marker["rows"]["synthetic_persons"] > 0
