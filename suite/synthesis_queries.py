"""Raking, integer weights, expansion and merging."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.control_queries import FORECAST, YEARS, ZONES
from suite.incidence_queries import (
    FITTING,
    HH_CONTROLS,
    INCIDENCE,
    SIG_CONTROLS,
    SIG_TARGETS,
    SIGS,
    duck,
    incidence_rows,
)
from suite.registry import query
from suite.seed_queries import SEED_HH, SEED_PP, H, P, seed_hh, seed_pp
from suite.standins import ctes, standin
from zonecraft.definitions import GQ_RUNS, MARGINS, PERSON_COLUMNS, RUN_ORDER
from zonecraft.operators import expand, incidence, raking, subzones
from zonecraft.operators.raking import Margin
from zonecraft.plans import synthesis
from zonecraft.session import stage

SH = "synthetic_households"
X = "geo_cross_walk"

WORKERS = Margin(tuple(MARGINS["workers"]))
SIZE = Margin(tuple(MARGINS["size"]))
SEX = Margin(tuple(MARGINS["sex"]), counts=True)

# Targets come from other weights of the same records, so a solution exists and differs from the start.
OTHER_WEIGHT = "(1 + WGTP % 3)"


def step_sql(before: str, after: str, zone: str, targets: str, margin: Margin, limit: float) -> str:
    """One margin adjustment in SQL: factors per zone, then the weights."""
    sums = ", ".join(
        f"sum(w * {t}) as x_{t}" + (f", sum(w * {t} * {t}) as y_{t}" if margin.counts else "") for t in margin.targets
    )

    def factor(t):
        if not margin.counts:
            return f"case when {t} is null or x_{t} = 0 then 1e0 else {t} / x_{t} end"
        return (
            f"case when {t} is null or y_{t} = 0 then 1e0 when {t} = 0 then 0e0 "
            f"else greatest(least(1 + ({t} - x_{t}) / y_{t}, 10e0), 0.1e0) end"
        )

    factors = ", ".join(f"{factor(t)} as f_{t}" for t in margin.targets)
    product = " * ".join(f"pow(f_{t}, {t})" for t in margin.targets)
    return f"""{after}_f as (select {zone}, {factors} from (select {zone}, {sums} from {before} group by {zone}) s
      left join {targets} using ({zone})),
    {after}_g as (select {before}.* exclude (w, g), g * {product} as g from {before} join {after}_f using ({zone})),
    {after} as (select *, w0 * least(g, {limit}e0) as w from {after}_g)"""


def sweeps_sql(start: str, zone: str, targets: str, margins, sweeps: int, limit: float) -> tuple[str, str]:
    parts, current = [], start
    for s in range(sweeps):
        for n, margin in enumerate(margins):
            following = f"{start}_{s}_{n}"
            parts.append(step_sql(current, following, zone, targets, margin, limit))
            current = following
    return ",\n".join(parts), current


PUMA_TARGETS = f"""tg as (select PUMA, {', '.join(f'cast(sum({OTHER_WEIGHT} * {t}) as double) as {t}' for t in SIG_TARGETS)}
  from inc_rows group by PUMA)"""
START = "st as (select sigs.* replace (cast(w0 as double) as w0), cast(w0 as double) as w, 1e0 as g from sigs)"
RAKE = f"{ctes(H, P)}, {INCIDENCE}, {SIGS}, {PUMA_TARGETS}, {START}"


def signature_rows(spark, sf):
    return incidence.signatures(incidence_rows(spark, sf, SIG_CONTROLS), ["PUMA"], SIG_TARGETS)


def alternative_targets(rows):
    return rows.groupBy("PUMA").agg(*[F.sum(F.expr(OTHER_WEIGHT) * F.col(t)).alias(t) for t in SIG_TARGETS])


def raked_pumas(spark, sf, margins, sweeps, limit=raking.MAX_EXPANSION):
    rows = stage(incidence_rows(spark, sf, SIG_CONTROLS))
    merged = incidence.signatures(rows, ["PUMA"], SIG_TARGETS)
    return raking.rake(merged, alternative_targets(rows), ["PUMA"], margins, sweeps, None, limit)


def rake_oracle(margins, sweeps, limit=raking.MAX_EXPANSION) -> str:
    steps, last = sweeps_sql("st", "PUMA", "tg", margins, sweeps, limit)
    return f"{RAKE}, {steps} select PUMA, sig, round(w, 4) as w from {last}"


@query("y04_rake", rake_oracle([WORKERS, SIZE, SEX], 2))
def _(spark, sf):
    return raked_pumas(spark, sf, [WORKERS, SIZE, SEX], 2).select("PUMA", "sig", F.round("w", 4).alias("w"))


@query("y05_cap_expansion", rake_oracle([SEX, SIZE], 1, 1.05))
def _(spark, sf):
    return raked_pumas(spark, sf, [SEX, SIZE], 1, 1.05).select("PUMA", "sig", F.round("w", 4).alias("w"))


@query(
    "y14_convergence",
    f"""{RAKE}, {sweeps_sql('st', 'PUMA', 'tg', [WORKERS, SIZE], 2, 30.0)[0]},
    sums as (select PUMA, {', '.join(f'sum(w * {t}) as x_{t}' for t in SIG_TARGETS)} from st_1_1 group by PUMA)
    select PUMA, round(greatest({', '.join(
        f'abs(x_{t} - {t}) / case when {t} <> 0 then {t} else 1 end' for t in SIG_TARGETS)}), 6) as gap
    from sums join tg using (PUMA)""",
)
def _(spark, sf):
    rows = stage(incidence_rows(spark, sf, SIG_CONTROLS))
    packed = stage(raking.pack(incidence.signatures(rows, ["PUMA"], SIG_TARGETS), SIG_TARGETS, ["PUMA"]))
    state = raking.rake_state(packed, alternative_targets(rows), ["PUMA"], SIG_TARGETS, [WORKERS, SIZE], 2, None)
    return raking.zone_gap(packed, state, ["PUMA"], SIG_TARGETS).withColumn("gap", F.round("gap", 6))


# --- regional controls -------------------------------------------------------------------------------------------

META_CONTROLS = [c for c in FITTING if c.geography == "region"]
META = [c.target for c in META_CONTROLS]
META_SQL = f"""placed as (select i.*, 1 + (PUMA - 7301) % 3 as region from inc_rows i),
  seen as (select region, PUMA, target, cast(sum(v) as bigint) as total from (
    {' union all '.join(f"select region, PUMA, '{t}' as target, WGTP * {t} as v from placed" for t in META)}) a
    group by region, PUMA, target),
  wanted as (select region, target, cast(sum(v) as bigint) as control_value from (
    {' union all '.join(f"select region, '{t}' as target, {OTHER_WEIGHT} * {t} as v from placed" for t in META)}) a
    group by region, target),
  shared as (select s.region, s.target, PUMA, case when sum(total) over (partition by s.region, s.target) <> 0
    then control_value * cast(total as double) / sum(total) over (partition by s.region, s.target) else 0 end as control_value
    from seen s join wanted w on w.region = s.region and w.target = s.target)"""


def meta_rows(spark, sf):
    rows = incidence_rows(spark, sf, SIG_CONTROLS + META_CONTROLS)
    return stage(rows.withColumn("region", 1 + (F.col("PUMA") - 7301) % 3))


def _long_sum(rows, keys, weight, name):
    wide = rows.groupBy(*keys).agg(*[F.sum(F.expr(weight) * F.col(t)).alias(t) for t in META])
    return wide.unpivot(keys, META, "target", name)


def factored(rows):
    weighted = _long_sum(rows, ["region", "PUMA"], "WGTP", "total")
    wanted = _long_sum(rows, ["region"], OTHER_WEIGHT, "control_value")
    return raking.factor_meta(wanted, weighted, ["region"], "PUMA")


@query(
    "y06_factor_meta",
    f"""{ctes(H, P)}, {INCIDENCE}, {META_SQL}
    select region, target, PUMA, round(control_value, 4) as control_value from shared""",
)
def _(spark, sf):
    return factored(meta_rows(spark, sf)).withColumn("control_value", F.round("control_value", 4))


FINAL_TARGETS = [*SIG_TARGETS, *META]
_jobs, _force = [Margin(tuple(t for t in META if t.startswith(kind)), counts=True) for kind in ("job_", "lfp_")]
FINAL_MARGINS = [_jobs, _force, WORKERS, SIZE]
_final_steps, _final_last = sweeps_sql("fst", "PUMA", "ftg", FINAL_MARGINS, 1, 30.0)


@query(
    "y07_final_rake",
    f"""{ctes(H, P)}, {INCIDENCE}, {PUMA_TARGETS}, {META_SQL},
    ftg as (select * from tg join (select PUMA, {', '.join(
        f"max(case when target = '{t}' then control_value end) as {t}" for t in META)} from shared group by PUMA) m
        using (PUMA)),
    fst as (select PUMA, {', '.join(FINAL_TARGETS)}, cast(sum(WGTP) as double) as w0, cast(sum(WGTP) as double) as w, 1e0 as g,
      min(hhid) as sig from inc_rows group by PUMA, {', '.join(FINAL_TARGETS)}),
    {_final_steps} select PUMA, sig, round(w, 4) as w from {_final_last}""",
)
def _(spark, sf):
    rows = meta_rows(spark, sf)
    merged = incidence.signatures(rows, ["PUMA"], FINAL_TARGETS)
    shares = factored(rows).groupBy("PUMA").pivot("target", META).agg(F.first("control_value"))
    targets = alternative_targets(rows).join(shares, "PUMA")
    weighted = raking.rake(merged, targets, ["PUMA"], FINAL_MARGINS, 1, None)
    return weighted.select("PUMA", "sig", F.round("w", 4).alias("w"))


# --- whole weights -----------------------------------------------------------------------------------------------

FLOAT_WEIGHT = "WGTP * 1.37e0 + household_id % 11 * 0.013e0"


@query(
    "y08_integerize",
    f"""{ctes(SH)}, f as (select mgra, household_id, round({FLOAT_WEIGHT}, 6) as w from synthetic_households),
    p as (select *, floor(w) as base, round(w - floor(w), 6) as rest from f),
    z as (select mgra, round(sum(w)) - sum(base) as need from p group by mgra)
    select p.mgra, household_id, cast(base + case when row_number() over (partition by p.mgra
      order by rest desc, household_id) <= need then 1 else 0 end as bigint) as integer_weight
    from p join z on z.mgra = p.mgra""",
)
def _(spark, sf):
    rows = standin(spark, sf, SH).select("mgra", "household_id", F.expr(FLOAT_WEIGHT).alias("w"))
    return raking.integerize(rows, ["mgra"], "w", "household_id").drop("w")


# --- zones inside a seed area ------------------------------------------------------------------------------------

ZONE_MARGINS = ["income", "workers", "size", "total"]
HH_TARGETS = [c.target for c in HH_CONTROLS]


def seed_predicate(control) -> str:
    """A household predicate with its columns qualified, for a query that joins two household tables."""
    return duck(control).replace("WGTP", "h.WGTP").replace("NP ", "h.NP ")


HH_INC = f"""hi as (select h.SERIALNO as hhid, h.PUMA, h.WGTP, s.mgra,
  {', '.join(f'cast(coalesce({seed_predicate(c)}, false) as int) as {c.target}' for c in HH_CONTROLS)}
  from seed_hh h join household_src s on s.SERIALNO = h.SERIALNO where gq_type = 0)"""
_WIDTH = {m: len(MARGINS[m]) + 1 for m in subzones.CELL_MARGINS}
_POS = {m: "(" + " + ".join(f"{n} * {t}" for n, t in enumerate(MARGINS[m], 1)) + ")" for m in subzones.CELL_MARGINS}
CELL_SQL = f"({_POS['size']} * {_WIDTH['workers']} + {_POS['workers']}) * {_WIDTH['income']} + {_POS['income']}"
# At sf0.01 some areas have fewer than 330 regular households, so both kinds of pool occur.
MIN_SAMPLES = 330
POOLS_SQL = f"""pools as (select PUMA, case when count(*) >= {MIN_SAMPLES} then PUMA else 0 end as pool
  from hi group by PUMA), pooled as (select hi.*, pool, {CELL_SQL} as cell from hi join pools using (PUMA) where pool <> 0
  union all select hi.*, 0 as pool, {CELL_SQL} from hi where exists (select 1 from pools where pool = 0)),
  cells as (select pool, cell, cast(sum(WGTP) as double) as w0, {', '.join(f'min({t}) as {t}' for t in HH_TARGETS)}
    from pooled group by pool, cell)"""
ZONE_SQL = f"""zt as (select mgra, PUMA, {', '.join(f'cast(sum({OTHER_WEIGHT} * {t}) as double) as {t}' for t in HH_TARGETS)}
  from hi group by mgra, PUMA), ztg as (select * exclude (PUMA) from zt),
  zst as (select mgra, pool, cell, w0, w0 as w, 1e0 as g, {', '.join(f'c.{t}' for t in HH_TARGETS)}
    from zt join pools using (PUMA) join cells c using (pool))"""
_zone_steps, _zone_last = sweeps_sql("zst", "mgra", "ztg", [Margin(tuple(MARGINS[m])) for m in ZONE_MARGINS], 2, 1e9)
ZONE_RAKE = f"{ctes(H, P)}, {SEED_HH}, {HH_INC}, {POOLS_SQL}, {ZONE_SQL}, {_zone_steps}"
ZONE_INT = f"""zi as (select mgra, pool, cell, round(w, 6) as w, floor(round(w, 6)) as base from {_zone_last} where w > 0),
  zn as (select mgra, sum(base) as floors from zi group by mgra),
  slots as (select zi.mgra, pool, cell, cast(base + case when row_number() over (partition by zi.mgra
    order by round(zi.w - base, 6) desc, cell) <= Total_HH - floors then 1 else 0 end as bigint) as n
    from zi join zn on zn.mgra = zi.mgra join ztg on ztg.mgra = zi.mgra)"""


def zone_setup(spark, sf):
    households = seed_hh(spark, sf).where("gq_type = 0").withColumnRenamed("SERIALNO", "hhid")
    homes = standin(spark, sf, H).select(F.col("SERIALNO").alias("hhid"), "mgra")
    seeds = stage(incidence.incidence(households, None, HH_CONTROLS, keep=("PUMA", "WGTP")).join(homes, "hhid"))
    controls = seeds.groupBy("mgra").agg(*[F.sum(F.expr(OTHER_WEIGHT) * F.col(t)).alias(t) for t in HH_TARGETS])
    placed = subzones.place_zones(controls, standin(spark, sf, X), subzones.pool_of_puma(seeds, MIN_SAMPLES))
    return seeds, controls, placed


def raked_zones(spark, sf, sweeps=2, tolerance=None):
    """Seeds, zone controls with their pool, and the raked zones."""
    seeds, _, placed = zone_setup(spark, sf)
    cells = subzones.pool_cells(subzones.seed_pools(seeds, placed), "WGTP")
    return seeds, placed, stage(subzones.rake_zones(placed, cells, ZONE_MARGINS, sweeps, tolerance))


@query(
    "j14_seed_pools",
    f"{ctes(H, P)}, {SEED_HH}, {HH_INC}, {POOLS_SQL} select pool, cell, w0 from cells",
)
def _(spark, sf):
    seeds, _, placed = zone_setup(spark, sf)
    return subzones.pool_cells(subzones.seed_pools(seeds, placed), "WGTP")


@query("y09_sub_balance", f"{ZONE_RAKE} select mgra, pool, cell, round(w, 4) as w from {_zone_last} where w > 0")
def _(spark, sf):
    _, _, raked = raked_zones(spark, sf)
    weights = subzones.cell_weights(raked)
    return weights.withColumn("w", F.round("w", 4))


@query("y09_zone_integers", f"{ZONE_RAKE}, {ZONE_INT} select mgra, pool, cell, n from slots")
def _(spark, sf):
    _, placed, raked = raked_zones(spark, sf)
    whole = subzones.integer_cells(subzones.cell_weights(raked), placed)
    return whole.select("mgra", "pool", "cell", F.col("integer_weight").alias("n"))


def fill_sql(slots: str, members: str, group: str) -> str:
    """Quotas by largest remainder and the unit-by-unit match of zones and households, in SQL."""
    return f"""tot as (select {group}, cast(sum(n) as bigint) as total from {slots} where n > 0 group by {group}),
    share as (select m.*, total, w * total // sum(w) over (partition by {group}) as base,
      w * total % sum(w) over (partition by {group}) as rest from {members} m join tot using ({group})),
    quota as (select *, cast(base + case when row_number() over (partition by {group} order by rest desc, hhid)
      <= total - sum(base) over (partition by {group}) then 1 else 0 end as bigint) as q from share),
    seats as (select {group}, hhid, q, coalesce(sum(q) over (partition by {group} order by hhid
      rows between unbounded preceding and 1 preceding), 0) as st from quota where q > 0),
    places as (select {group}, mgra, n, coalesce(sum(n) over (partition by {group} order by mgra
      rows between unbounded preceding and 1 preceding), 0) as st from {slots} where n > 0),
    taken as (select {group}, hhid, cast(st + u as bigint) as unit from seats, unnest(range(q)) t(u)),
    opened as (select {group}, mgra, cast(st + u as bigint) as unit from places, unnest(range(n)) t(u))"""


@query(
    "y09_fill_zones",
    f"""{ZONE_RAKE}, {ZONE_INT}, members as (select pool, cell, hhid, cast(WGTP as bigint) as w from pooled),
    {fill_sql('slots', 'members', 'pool, cell')} select mgra, hhid, count(*) as integer_weight
    from opened join taken using (pool, cell, unit) group by mgra, hhid""",
)
def _(spark, sf):
    seeds, placed, raked = raked_zones(spark, sf)
    whole = subzones.integer_cells(subzones.cell_weights(raked), placed)
    slots = whole.select("mgra", "pool", "cell", F.col("integer_weight").alias("n"))
    members = subzones.seed_pools(seeds, placed).select("pool", subzones.cell_id().alias("cell"), "hhid", F.col("WGTP").alias("w"))
    return expand.zone_weights(expand.fill_zones(slots, members, ["pool", "cell"], order="hhid"))


GQ_SLOTS = """gslots as (select synthesis_run, mgra, count(*) as n from synthetic_households
  where gq_type <> 0 group by synthesis_run, mgra)"""
RUN_SQL = "case gq_type when 1 then 'gq_mil' when 2 then 'gq_col' when 3 then 'gq_oth' end"


@query(
    "y13_gq_synthesis",
    f"""{ctes(H, P, SH)}, {SEED_HH}, {GQ_SLOTS}, gm as (select {RUN_SQL} as synthesis_run, SERIALNO as hhid,
      cast(WGTP as bigint) as w from seed_hh where gq_type <> 0),
    {fill_sql('gslots', 'gm', 'synthesis_run')} select synthesis_run, mgra, hhid, count(*) as integer_weight
    from opened join taken using (synthesis_run, unit) group by synthesis_run, mgra, hhid""",
)
def _(spark, sf):
    from zonecraft.operators.seed import split_runs

    quarters = split_runs(seed_hh(spark, sf)).where("gq_type <> 0")
    members = quarters.select("synthesis_run", F.col("SERIALNO").alias("hhid"), F.col("WGTP").alias("w"))
    population = standin(spark, sf, SH).where("gq_type <> 0")
    slots = population.groupBy("synthesis_run", "mgra").agg(F.count("*").alias("n"))
    filled = expand.fill_zones(slots, members, ["synthesis_run"], order="hhid")
    return expand.zone_weights(filled, keep=("synthesis_run",))


# --- expansion ---------------------------------------------------------------------------------------------------

WEIGHTS = """weights as (select mgra, household_id as hhid, WGTP % 4 as integer_weight from synthetic_households),
  starts as (select *, coalesce(sum(integer_weight) over (order by mgra, hhid
    rows between unbounded preceding and 1 preceding), 0) as start from weights)"""


def weights(spark, sf):
    return standin(spark, sf, SH).select(
        "mgra", F.col("household_id").alias("hhid"), (F.col("WGTP") % 4).alias("integer_weight")
    )


@query(
    "y10_expand",
    f"""{ctes(SH)}, {WEIGHTS} select mgra, hhid, cast(r as bigint) as replica
    from weights, unnest(range(integer_weight)) t(r)""",
)
def _(spark, sf):
    return expand.expand(weights(spark, sf), "integer_weight").select("mgra", "hhid", "replica")


@query(
    "w05_replica_ids",
    f"""{ctes(SH)}, {WEIGHTS} select mgra, hhid, cast(start + r + 1 as bigint) as household_id
    from starts, unnest(range(integer_weight)) t(r)""",
)
def _(spark, sf):
    return expand.expand_households(weights(spark, sf)).select("mgra", "hhid", "household_id")


@query(
    "j13_replica_persons",
    f"""{ctes(SH, P)}, {WEIGHTS} select s.mgra, hhid, SPORDER, AGEP, cast(start + r + 1 as bigint) as household_id
    from starts s, unnest(range(integer_weight)) t(r), person_src p where p.household_id = hhid""",
)
def _(spark, sf):
    persons = standin(spark, sf, P).select(F.col("household_id").alias("hhid"), "SPORDER", "AGEP")
    expanded = expand.expand_persons(weights(spark, sf), persons)
    return expanded.select("mgra", "hhid", "SPORDER", "AGEP", "household_id")


@query(
    "y15_synthetic_output",
    f"""{ctes(SH, X)} select household_id, s.mgra, PUMA, SERIALNO, NP, HHADJINC, HHT, HUPAC, VEH, BLD, gq_type, workers
    from synthetic_households s join geo_cross_walk x on x.mgra = s.mgra""",
)
def _(spark, sf):
    placed = incidence.with_puma(standin(spark, sf, SH), standin(spark, sf, X), "mgra")
    return expand.household_output(placed)


PERSON_OUT = ", ".join(f"p.{c}" for c in PERSON_COLUMNS)


@query(
    "y15_person_output",
    f"""{ctes(SH, X, H, P)}, {SEED_PP} select household_id, s.mgra, x.PUMA, {PERSON_OUT}
    from seed_pp p join synthetic_households s on s.SERIALNO = p.SERIALNO join geo_cross_walk x on x.mgra = s.mgra""",
)
def _(spark, sf):
    households = standin(spark, sf, SH).select("SERIALNO", "household_id", "mgra")
    members = seed_pp(spark, sf).drop("PUMA").join(households, "SERIALNO")
    return expand.person_output(incidence.with_puma(members, standin(spark, sf, X), "mgra"))


# Each run numbers its own households 1..n.
RUN_IDS = """own as (select synthesis_run, mgra, row_number() over (partition by synthesis_run order by household_id)
  as household_id, SERIALNO from synthetic_households),
  off as (select r.run as synthesis_run, coalesce(sum(n) over (order by pos rows between unbounded preceding and 1
    preceding), 0) as off from (values ('gq_mil', 1), ('gq_col', 2), ('gq_oth', 3), ('household', 4)) r(run, pos)
    join (select synthesis_run, count(*) as n from own group by synthesis_run) c on c.synthesis_run = run)"""


def own_ids(spark, sf):
    from zonecraft.operators.running import number_rows

    rows = standin(spark, sf, SH).select("synthesis_run", "mgra", "SERIALNO", F.col("household_id").alias("key"))
    return number_rows(rows, ["synthesis_run"], ["key"], "household_id").drop("key")


@query(
    "w03_offset_ids",
    f"""{ctes(SH)}, {RUN_IDS} select o.synthesis_run, mgra, SERIALNO, cast(household_id + off as bigint) as household_id
    from own o join off on off.synthesis_run = o.synthesis_run""",
)
def _(spark, sf):
    rows = own_ids(spark, sf)
    return expand.offset_ids(rows, expand.run_offsets(rows))


@query(
    "u01_stack_runs",
    f"{ctes(SH)} select synthesis_run, household_id, mgra, gq_type from synthetic_households",
)
def _(spark, sf):
    rows = standin(spark, sf, SH)
    of_run = lambda run: rows.where(F.col("synthesis_run") == run).select("household_id", "mgra", "gq_type")
    return expand.stack_runs({run: of_run(run) for run in RUN_ORDER})


@query(
    "p22_merged_households",
    f"""{ctes(SH, X)} select household_id, mgra, SERIALNO, case when HHADJINC < 0 then 0 else HHADJINC end as HHADJINC,
    coalesce(HHT, 0) as HHT, coalesce(HUPAC, 0) as HUPAC, coalesce(BLD, 0) as BLD from synthetic_households""",
)
def _(spark, sf):
    rows = incidence.with_puma(standin(spark, sf, SH), standin(spark, sf, X), "mgra")
    columns = ["household_id", "mgra", "SERIALNO", "HHADJINC", "HHT", "HUPAC", "BLD"]
    return expand.merged_households(rows.select("PUMA", *columns)).select(*columns)


FILLED = ["ESR", "COW", "WKHP", "SCHG", "MIL", "SCHL", "OCCP", "WKW"]


@query(
    "p23_merged_persons",
    f"""{ctes(P)} select household_id, SPORDER, NAICSP, SOCP, {', '.join(f'coalesce({c}, 0) as {c}' for c in FILLED)}
    from person_src""",
)
def _(spark, sf):
    columns = ["household_id", "SPORDER", "NAICSP", "SOCP", *FILLED]
    rows = standin(spark, sf, P).select(F.lit(1).alias("PUMA"), *columns)
    return expand.merged_persons(rows)


# --- the whole chain ---------------------------------------------------------------------------------------------


@query(
    "y16_synthesis_chain",
    f"""{ctes(*FORECAST)}, {ZONES}, gq as ({' union all '.join(
        f"select increment, '{run}' as synthesis_run, mgra, {pop} as households from zones" for run, _, pop, _, _ in GQ_RUNS)})
    select * from gq where households > 0 union all
    select increment, 'household', mgra, Total_HH from zones where Total_HH > 0""",
)
def _(spark, sf):
    """Seeds to finished population of all forecast years; every zone must hold exactly its households of every run."""
    seeds = synthesis.build_seeds(standin(spark, sf, H), standin(spark, sf, P))
    inputs = [standin(spark, sf, name) for name in (*FORECAST, "economic_controls")]
    controls = synthesis.build_controls(*inputs, YEARS)
    settings = synthesis.Settings(accept_open=True)
    result = synthesis.synthesize(seeds, controls, standin(spark, sf, X), settings)
    return result.households.groupBy("increment", "synthesis_run", "mgra").agg(F.count("*").alias("households"))
