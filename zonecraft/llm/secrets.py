"""Secret scan in built-in functions only: patterns, and sliding-window entropy with an allow list.

Patterns, each leftmost and not overlapping itself: assignments to password-like names, access keys, long hex runs.

Entropy. A candidate is a run of at least ``WINDOW`` characters of ``ALPHABET`` that holds a letter and a digit; of a run
that a pattern's span touches, the parts that no span covers are candidates by themselves. Its class is hex (hex digits
only) or mixed. A window of ``WINDOW`` characters slides along it with
a count per character: with f(c) = c log2 c, taking in a character seen c times adds f(c + 1) - f(c) to a running sum,
letting one go takes f(c) - f(c - 1) away, and the window's Shannon entropy is log2(WINDOW) - sum / WINDOW.

The allow list excuses only what it names. Of a run the segments (letters and digits between other characters) that hold
a word of ``EXAMPLES`` are left out, then the characters of ``SEQUENCES``. What stands between these is judged part by
part: a part that is a candidate by itself, is not ``ALLOWED`` as a whole and has a window that reaches the threshold of
its class makes the whole run a secret. A word that touches a value without a character between excuses it.

Positions are code points from 0, ends exclusive. NULL and empty texts have no spans. Rows are independent of each other;
ties, repeated rows and NULL ids change nothing, and columns other than ``text`` are passed through or not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecraft.llm.common import as_rows, from_rows

# The patterns to find.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_LEAST = 8
KINDS = ["assign", "access", "hex", "entropy"]

WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Z+/_=a-z-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{20,}"
# Bits per character that a window of random characters of the class nearly always has and a written name rarely.
HEX_LEAST = 2.9
MIXED_LEAST = 3.75
EXAMPLES = r"(?i)(?<![a-z0-9])[a-z0-9]*?(?:example|sample|dummy|placeholder|changeme|redacted)[a-z0-9]*"
SEQUENCES = r"(?i)0123456789|abcdefghij(?:klmnopqrstuvwxyz)?|qwertyuiop(?:asdfghjkl(?:zxcvbnm)?)?|(.)\1{5,}"
ALLOWED = [
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # identifiers of records
    r"^[A-Za-z]*[0-9]{1,4}$|^[0-9]{1,4}[A-Za-z]+$",  # a word with a number
    r"^([A-Za-z]+|[0-9]+)([/_=-]+([A-Za-z]+|[0-9]+))+$",  # paths, names with dashes, dates
]


SPANS = "array<struct<start:int,kind:int,end:int>>"
RUNS = "array<struct<start:int,kind:int,end:int,run:string>>"


def found_spans(text: Column, pattern: str, kind: int, keep=None, group: int = 0, runs: bool = False) -> Column:
    """Spans of the pattern's matches that ``keep`` (on the match's group) accepts: start, kind, end, with ``runs`` the match."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    between = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    rows = F.arrays_zip(found.alias("match"), judged.alias("part"), between.alias("gap"))
    # One row more than matches: what follows the last one.
    start = F.struct(
        F.lit(0).alias("at"),
        F.array().cast(RUNS if runs else SPANS).alias("spans"),
    )

    def step(state: Column, row: Column) -> Column:
        first = state["at"] + row["gap"]
        end = first + F.length(row["match"])
        own = [row["match"].alias("run")] if runs else []
        span = F.struct(first.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), *own)
        accepted = row["match"].isNotNull() & (keep(row["part"]) if keep else F.lit(True))
        spans = F.when(accepted, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(F.coalesce(end, first).alias("at"), spans.alias("spans"))

    spans = F.aggregate(rows, start, step, lambda state: state["spans"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(RUNS if runs else SPANS))


def weigh(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(0.0)


def highest_entropy(run: Column) -> Column:
    """The highest entropy of a window of ``WINDOW`` characters of the run, from counts kept as the window moves."""
    letters = F.transform(F.filter(F.split(run, ""), lambda c: c != ""), lambda c: F.position(c, F.lit(ALPHABET)))
    # Beside each character the one that leaves the window when it comes; 0 while the window fills.
    late = F.slice(F.concat(F.array_repeat(F.lit(0), WINDOW), letters), 1, F.length(run))
    moves = F.arrays_zip(letters.alias("comes"), late.alias("goes"))
    counts = F.array_repeat(F.lit(0), len(ALPHABET) + 1)
    zero = [F.lit(0).alias("n"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best")]
    start = F.struct(counts.alias("counts"), *zero)

    def step(state: Column, move: Column) -> Column:
        comes, goes = move["comes"], move["goes"]
        full = goes > 0
        left = F.element_at(state["counts"], goes + 1)
        less = F.when(full, weigh(left) - weigh(left - 1)).otherwise(0.0)
        # The count of the one that comes, after the other has gone.
        seen = F.element_at(state["counts"], comes + 1) - F.when(full & (comes == goes), 1).otherwise(0)
        total = state["sum"] - less + weigh(seen + 1) - weigh(seen)
        moved = F.transform(
            state["counts"],
            lambda c, j: c + F.when(j == comes, 1).otherwise(0) - F.when(full & (j == goes), 1).otherwise(0),
        )
        n = state["n"] + 1
        entropy = F.when(n >= WINDOW, F.lit(math.log2(WINDOW)) - total / WINDOW).otherwise(0.0)
        best = F.greatest(state["best"], entropy)
        return F.struct(moved.alias("counts"), n.alias("n"), total.alias("sum"), best.alias("best"))

    return F.aggregate(moves, start, step, lambda state: state["best"])


def is_random(run: Column) -> Column:
    """Whether a part of the run that no allowed word or sequence belongs to is random."""
    rest = F.regexp_replace(F.regexp_replace(run, EXAMPLES, " "), SEQUENCES, " ")

    def judged(part: Column) -> Column:
        # Characters that joined the part to what was left out do not keep it from being an allowed name.
        bare = F.when(part == run, part).otherwise(F.regexp_replace(part, "^[+/_=-]+|[+/_=-]+$", ""))
        known = F.lit(False)
        for pattern in ALLOWED:
            known = known | bare.rlike(pattern)
        candidate = (F.length(part) >= WINDOW) & part.rlike("[0-9]") & part.rlike("[A-Za-z]")
        least = F.when(part.rlike("^[0-9A-Fa-f]+$"), HEX_LEAST).otherwise(MIXED_LEAST)
        return F.when(candidate & ~known, highest_entropy(part) >= least).otherwise(False)

    return F.exists(F.split(rest, " +"), judged)


def uncovered(run: Column, base: Column) -> Column:
    """The parts of a run that no base span covers: all of it, or what lies before, between and after the spans."""
    over = F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))

    def part(first: Column, end: Column) -> Column:
        own = F.substr(run["run"], first - run["start"] + 1, F.greatest(end - first, F.lit(0)))
        return F.struct(first.alias("start"), F.lit(3).alias("kind"), end.alias("end"), own.alias("run"))

    def between(i: Column) -> Column:
        # Spans are sorted by their start; one may end after the next.
        first = F.array_max(F.transform(F.slice(over, 1, i), lambda b: b["end"]))
        first = F.greatest(F.coalesce(first, run["start"]), run["start"])
        return part(first, F.coalesce(F.get(over, i)["start"], run["end"]))

    return F.when(F.size(over) == 0, F.array(run)).otherwise(F.transform(F.sequence(F.lit(0), F.size(over)), between))


def scan(docs: DataFrame) -> DataFrame:
    """``doc`` (the caller's row), ``text`` (NULL: empty), the base spans by kind, ``base`` and ``spans``: arrays of
    (start, kind, end), sorted; kinds are places in ``KINDS``."""
    text = F.coalesce(F.col("doc").getField("text").cast("string"), F.lit(""))
    found = as_rows(docs).withColumn("text", text).withColumns(
        {
            "assign": found_spans(F.col("text"), ASSIGN, 0, lambda v: F.length(v) >= ASSIGN_LEAST, group=1),
            "access": F.when(F.col("text").contains("AKIA"), found_spans(F.col("text"), ACCESS, 1)).otherwise(F.array()),
            "hex": found_spans(F.col("text"), HEX, 2),
            "runs": found_spans(F.col("text"), CANDIDATE, 3, runs=True),
        }
    )
    based = found.withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))
    parts = F.flatten(F.transform("runs", lambda r: uncovered(r, F.col("base"))))
    random = F.filter(parts, lambda p: is_random(p["run"]))
    random = F.transform(random, lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end")))
    random = F.when(F.size("runs") > 0, random).otherwise(F.array().cast(SPANS))
    return based.withColumn("spans", F.array_sort(F.concat("base", random)))


def written(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"])), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts per kind, the base spans and all spans as text."""
    found = scan(docs.select("doc_id", "text"))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    doc_id = F.col("doc").getField("doc_id").alias("doc_id")
    return found.select(doc_id, *counts, written(F.col("base")).alias("base_spans"), written(F.col("spans")).alias("spans"))


def without_secrets(docs: DataFrame, mark: str = "<secret>") -> DataFrame:
    """``docs`` with each span of its text replaced by ``mark``; where spans overlap, by one. Other rows stay as they are."""
    found = scan(docs)
    text = F.col("text")
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(state: Column, span: Column) -> Column:
        before = F.substr(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        overlaps = span["start"] < state["at"]
        done = F.when(overlaps, state["done"]).otherwise(F.concat(state["done"], before, F.lit(mark)))
        return F.struct(done.alias("done"), F.greatest(state["at"], span["end"]).alias("at"))

    rest = lambda state: F.concat(state["done"], F.substr(text, state["at"] + 1, F.length(text)))
    own = F.col("doc").getField("text")
    kept = found.withColumn("clean", F.when(F.size("spans") > 0, F.aggregate("spans", start, step, rest)).otherwise(own))
    changed = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        before = F.col("doc").getField("n_chars")
        changed["n_chars"] = F.when(F.size("spans") > 0, F.length("clean").cast(kind)).otherwise(before)
    return from_rows(kept, docs.columns, changed)
