"""Control definitions: what each control counts, at which geography, and in which population.

A definition's predicate is a Spark SQL boolean expression over the household or person table. Predicates with a
NULL operand are NULL and are not counted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values: these must equal the published control set. ---------------------------------------------------
# name, lowest age, highest age (None = open)
AGE_BANDS = [
    ("Age_LT5", 0, 4),
    ("Age_5to9", 5, 9),
    ("Age_10to14", 10, 14),
    ("Age_15to17", 15, 17),
    ("Age_18to24", 18, 24),
    ("Age_25to34", 25, 34),
    ("Age_35to44", 35, 44),
    ("Age_45to54", 45, 54),
    ("Age_55to64", 55, 64),
    ("Age_65to74", 65, 74),
    ("Age_75to84", 75, 84),
    ("Age_85Plus", 85, None),
]
# first and last code of the forecast's age groups per age band, in the order of AGE_BANDS
AGE_GROUP_IDS = [(1, 1), (2, 2), (3, 3), (4, 4), (5, 6), (7, 8), (9, 10), (11, 12), (13, 15), (16, 17), (18, 19), (20, 21)]
# name, lowest income, highest income (None = open)
INCOME_BANDS = [
    ("HHInc_0to14999", 0, 14999),
    ("HHInc_15000to29999", 15000, 29999),
    ("HHInc_30000to59999", 30000, 59999),
    ("HHInc_60000to99999", 60000, 99999),
    ("HHInc_100000to149999", 100000, 149999),
    ("HHInc_150000to199999", 150000, 199999),
    ("HHInc_200000Plus", 200000, None),
]
# income columns of the land-use table that make up each income band
INCOME_SOURCES = [(1,), (2,), (3, 4), (5, 6), (7, 8), (9,), (10,)]
RACE_CONTROLS = {
    "Asian": "Asian alone",
    "Black": "Black or African American alone",
    "Hispanic": "Hispanic",
    "Other": "Other",
    "Two_or_more": "Two or More Races",
    "White": "White alone",
}
# the forecast's ethnicity codes per race control
ETHNICITY_IDS = {"Asian": (5,), "Black": (3,), "Hispanic": (1,), "Other": (4, 6, 7), "Two_or_more": (8,), "White": (2,)}
JOB_SECTORS = {
    "job_1": ("92",),
    "job_2": ("MIL",),
    "job_3": ("11", "21"),
    "job_4": ("51", "54", "56"),
    "job_5": ("52", "53", "55"),
    "job_6": ("61",),
    "job_7": ("62",),
    "job_8": ("44", "45", "4M"),
    "job_9": ("23", "48", "49"),
    "job_10": ("22", "31", "32", "33", "42", "3M"),
    "job_11": ("71",),
    "job_12": ("721",),
    "job_13": ("722",),
    "job_14": ("81",),
}
LABOR_FORCE_RACES = {
    "lfp_black": ("Black or African American alone",),
    "lfp_hispanic": ("Hispanic",),
    "lfp_other": ("Other", "Two or More Races", "Asian alone"),
    "lfp_white": ("White alone",),
}
# group-quarters runs: name, type code, population column of the zone controls, control field, importance
GQ_RUNS = [
    ("gq_mil", 1, "gq_mil_pop", "GQ_Military", 10_000_000_000),
    ("gq_col", 2, "gq_college_pop", "GQ_College", 10_000_000_000),
    ("gq_oth", 3, "gq_other_pop", "GQ_Other", 5_000_000_000),
]
# order in which the runs are stacked
RUN_ORDER = ["gq_mil", "gq_col", "gq_oth", "household"]
MGRABASE_COLUMNS = (
    "mgra taz LUZ pop hhp hs hs_sf hs_mf hs_mh hh hh_sf hh_mf hh_mh hhs gq_civ gq_mil i1 i2 i3 i4 i5 i6 i7 i8 i9 i10 "
    "emp_gov emp_mil emp_ag_min emp_bus_svcs emp_fin_res_mgm emp_educ emp_hlth emp_ret emp_trn_wrh emp_con emp_utl "
    "emp_mnf emp_whl emp_ent emp_accm emp_food emp_oth emp_non_ws_wfh emp_non_ws_oth emp_total pseudomsa zip "
    "enrollgradekto8 enrollgrade9to12 majorcollegeenroll_total othercollegeenroll_total hotelroomtotal parkactive "
    "openspaceparkpreserve beachactive district27 milestocoast acre landacre effective_acres truckregiontype"
).split()
HOUSEHOLD_COLUMNS = "SERIALNO NP HHADJINC HHT HUPAC VEH BLD gq_type workers".split()
PERSON_COLUMNS = (
    "SERIALNO SPORDER AGEP SEX ESR COW WKHP SCHG RAC1P HISP MIL SCHL OCCP WKW NAICSP NAICS2 SOCP SOC2"
).split()
# -----------------------------------------------------------------------------------------------------------------

ECONOMIC_LABELS = [*JOB_SECTORS, *LABOR_FORCE_RACES]


@dataclass(frozen=True)
class Control:
    target: str
    geography: str
    seed_table: str
    importance: int | None
    predicate: str
    control_field: str | None = None
    population: str | None = None

    @property
    def field(self) -> str:
        return self.control_field or self.target

    def matches(self) -> Column:
        return F.expr(self.predicate)


def _band(column: str, low: int, high: int | None) -> str:
    return f"{column} >= {low}" if high is None else f"{column} between {low} and {high}"


def _listed(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def fitting_controls() -> list[Control]:
    """The controls that weights are fitted to: 37 per zone and 18 per region."""
    infinity = "double('infinity')"
    household = [Control("Total_HH", "mgra", "households", 1_000_000_000, f"WGTP > 0 and WGTP < {infinity}")]
    household += [Control(f"HHSize_{n}", "mgra", "households", 250_000, f"NP = {n}") for n in (1, 2, 3)]
    household += [Control("HHSize_4Plus", "mgra", "households", 250_000, "NP >= 4")]
    household += [
        Control(name, "mgra", "households", 100_000, _band("HHADJINC", low, high)) for name, low, high in INCOME_BANDS
    ]
    household += [Control(f"HHWork_{n}", "mgra", "households", 100_000, f"workers = {n}") for n in (0, 1, 2)]
    household += [Control("HHWork_3Plus", "mgra", "households", 100_000, "workers >= 3")]
    person = [
        Control("Total_Pop", "mgra", "persons", 1_000_000, "AGEP >= 0"),
        Control("Male", "mgra", "persons", 1_000_000, "SEX = 1"),
        Control("Female", "mgra", "persons", 1_000_000, "SEX = 2"),
    ]
    person += [Control(name, "mgra", "persons", 100_000, _band("AGEP", low, high)) for name, low, high in AGE_BANDS]
    person += [Control(name, "mgra", "persons", 200_000, f"race = '{label}'") for name, label in RACE_CONTROLS.items()]
    person += [
        Control(name, "region", "persons", 350_000, f"NAICS2 in {_listed(codes)} and laborforce = 1")
        for name, codes in JOB_SECTORS.items()
    ]
    person += [
        Control(name, "region", "persons", 1_225_000, f"race in {_listed(races)} and ESR in (1, 2, 3)")
        for name, races in LABOR_FORCE_RACES.items()
    ]
    return household + person


GEOGRAPHIES = ("mgra", "PUMA", "region")
SEED_TABLES = ("households", "persons")


def checked_controls(controls: list[Control]) -> list[Control]:
    """The same controls; a target that stands twice, an unknown geography, table or population, or an importance that is
    not positive raises."""
    seen: set[str] = set()
    for c in controls:
        if c.target in seen:
            raise ValueError(f"target {c.target} is defined twice")
        seen.add(c.target)
        for kind, value, known in (("geography", c.geography, GEOGRAPHIES), ("seed table", c.seed_table, SEED_TABLES)):
            if value not in known:
                raise ValueError(f"target {c.target} has the {kind} {value!r}, which is none of {', '.join(known)}")
        if c.population is not None and c.population not in SEED_TABLES:
            raise ValueError(f"target {c.target} counts the population {c.population!r}")
        if c.importance is not None and c.importance <= 0:
            raise ValueError(f"target {c.target} has the importance {c.importance}")
    return controls


def reporting_controls() -> list[Control]:
    """Compared with the result but not fitted to."""
    return [
        Control("HHChild_0", "mgra", "households", None, "HUPAC = 4", population="households"),
        Control("HHChild_1Plus", "mgra", "households", None, "HUPAC in (1, 2, 3)", population="households"),
    ]


def gq_controls() -> dict[str, Control]:
    """The single control of each group-quarters run; all three share one target name."""
    return {
        name: Control("Total_GQ", "mgra", "households", importance, f"gq_type = {code}", control_field=field)
        for name, code, _, field, importance in GQ_RUNS
    }


# Mutually exclusive categories, in ascending importance.
MARGINS = {
    "income": [name for name, _, _ in INCOME_BANDS],
    "workers": ["HHWork_0", "HHWork_1", "HHWork_2", "HHWork_3Plus"],
    "age": [name for name, _, _ in AGE_BANDS],
    "race": list(RACE_CONTROLS),
    "size": ["HHSize_1", "HHSize_2", "HHSize_3", "HHSize_4Plus"],
    "sex": ["Male", "Female"],
    "total": ["Total_HH"],
}


def definitions_frame(spark: SparkSession, controls: list[Control]) -> DataFrame:
    rows = [
        (n, c.target, c.geography, c.seed_table, c.importance, c.field, c.population, c.predicate)
        for n, c in enumerate(controls, 1)
    ]
    return spark.createDataFrame(
        rows,
        "ordinal int, target string, geography string, seed_table string, importance long, control_field string, "
        "population string, predicate string",
    )
