"""Mixing of sources to target weights by Pareto order sampling.

Sizes are words. Sources in code point order (NULL last) weigh 5, 2, 1, 5, 2, 1, ...; the mix has ``SHARE`` times the
words of all documents. A source's target is its weighted part, at most ``MOST`` times its words; what lies above is
shared again by weight until no target is above. That is min(MOST * words, level * weight) with one level for all.

A source whose target is r times its words takes every document floor(r) times. What its target then lacks is a sample in
which a document of some words has an inclusion probability p in proportion to their ``TILT``-th power, such that the
expected words are those lacking. Documents whose probability would be 1 or more are certain: they are taken out first, and
the others share what is left. Of these exactly the sum of their probabilities, rounded, are taken: the ones with the
smallest ranking value, their random odds u / (1 - u) over their inclusion odds p / (1 - p). u is a hash of source, id and
text with a fixed seed, so reruns agree.

The sample has the right number of documents; its words miss the target by chance. Documents next in the order are added
while they fit the gap, or the last ones dropped while they fit what is too much, and at last the one document that comes
nearest to what is still missing is added.

NULL and empty texts have size 0 and count as documents without words: they are copied like the others but take
nothing. Equal rows have equal random numbers and follow each other; they are taken one by one. Sources without words have
target 0. An empty table gives no rows. Where the rows themselves are wanted, with all columns, whatever their names, they
are numbered and written first: each is repeated by its own number, whatever its id.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecraft.llm.common import Stages, as_rows, from_rows, map_batches, typed
from zonecraft.llm.words import blocks
from zonecraft.operators.running import number_rows, running_total

SHARE = 1.5
MOST = 2.0
WEIGHTS = (5, 2, 1)
TILT = 0.5  # a document of four times the words is twice as likely to be taken
SENT = 100_000  # sources that may be sent to every task: some 10 MB
SEED = 15_485_863
NO_SOURCE = "\U0010ffff\U0010ffff"  # stands after every source; NULL is told apart by a column of its own


def sizes(docs: DataFrame) -> DataFrame:
    """``row, doc_id, source, known, size, u``: one row per row of ``docs``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for first, last, words in blocks(batch.column(3)):
                own = batch.slice(first, last - first)
                named = {name: own.column(i) for i, name in enumerate(("doc_id", "source", "draw"))}
                yield {"row": own.column(4), "size": words.counts} | named

    text = F.coalesce("text", F.lit(""))
    draw = F.xxhash64(F.lit(SEED), F.coalesce("source", F.lit("")), F.coalesce("doc_id", F.lit(-1)), text)
    counted = map_batches(
        docs.select("doc_id", "source", draw.alias("draw"), text.alias("text"), "row"),
        "doc_id long, source string, draw long, size long, row long",
        work,
    )
    # 53 of the 64 bits, as a number strictly between 0 and 1.
    u = (F.shiftrightunsigned("draw", 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return counted.select(
        "row",
        "doc_id",
        F.coalesce("source", F.lit(NO_SOURCE)).alias("source"),
        F.col("source").isNotNull().alias("known"),
        "size",
        u.alias("u"),
    )


def targets(sized: DataFrame) -> DataFrame:
    """``source, known, source_size, target``."""
    sources = sized.groupBy("source", "known").agg(F.sum("size").alias("source_size"))
    numbered = number_rows(sources, [], [F.col("known").desc(), "source"], "number")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("number") - 1).cast("int") % len(WEIGHTS) + 1)
    weighed = numbered.withColumn("weight", weight).withColumn("bound", MOST * F.col("source_size") / F.col("weight"))
    # The level at which the sources with smaller bounds are at their bound and the others share the rest.
    order = [F.col("bound"), F.col("number")]
    below = running_total(weighed, [], order, "source_size", "full_below")
    below = running_total(below, [], order, "weight", "weight_below")
    whole = weighed.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")).first()
    if not whole.words:
        return weighed.select("source", "known", "source_size", F.lit(0.0).alias("target"))
    level = (SHARE * whole.words - MOST * F.col("full_below")) / (whole.weights - F.col("weight_below"))
    # Sources up to the first one that the level does not fill are at their bound; the level there is the answer.
    answer = below.withColumn("level", level).where("level <= bound").agg(F.min_by("level", F.struct("bound", "number"))).first()[0]
    target = F.least(MOST * F.col("source_size"), F.lit(float("inf") if answer is None else answer) * F.col("weight"))
    return weighed.select("source", "known", "source_size", target.alias("target"))


def beside(rows: DataFrame, sources: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with what is known of their source. Sources are sent to every task where they are counted to be few, so that a
    hot one stays where its rows are."""
    few = sources.count() <= SENT
    return rows.join(F.broadcast(sources) if few else sources, keys)


def inclusion(rows: DataFrame, stages: Stages) -> DataFrame:
    """Add ``p``, the inclusion probability of one more copy: 1 for certain documents, 0 for those without words.

    ``rows`` have ``source, size, lacking``. The level c with sum(min(1, c * size**TILT) * size) = lacking is found from
    the sizes that occur, largest first; they are few beside the documents.
    """
    kinds = rows.where("size > 0 and lacking > 0").groupBy("source", "size").agg(F.count("*").alias("n"), F.any_value("lacking").alias("lacking"))
    weight = F.pow(F.col("size"), F.lit(TILT))
    words = F.col("n") * F.col("size")
    kinds = kinds.withColumns({"weight": weight, "words": words, "heft": weight * words, "order": -F.col("size")})
    kinds = running_total(kinds, ["source"], ["order"], "words", "certain")
    kinds = stages.write(running_total(kinds, ["source"], ["order"], "heft", "heft_before"), "sizes")
    whole = kinds.groupBy("source").agg(F.sum("heft").alias("hefts"))
    level = (F.col("lacking") - F.col("certain")) / (F.col("hefts") - F.col("heft_before"))
    # The first size that the level of what is left does not make certain; all larger ones are.
    levels = beside(kinds, whole, ["source"]).where(F.col("hefts") > F.col("heft_before")).withColumn("level", level)
    open_sizes = levels.where(F.col("level") * F.col("weight") < 1)
    first = open_sizes.groupBy("source").agg(F.min_by("level", "order").alias("level"), F.max("size").alias("below"))
    joined = rows.join(F.broadcast(first) if first.count() <= SENT else first, "source", "left")
    p = F.when((F.col("size") == 0) | (F.col("lacking") <= 0), 0.0)
    p = p.when(F.col("below").isNull() | (F.col("size") > F.col("below")), 1.0)
    p = p.otherwise(F.least(F.greatest(F.col("level"), F.lit(0.0)) * F.pow(F.col("size"), F.lit(TILT)), F.lit(1.0)))
    return joined.withColumn("p", p).drop("level", "below")


def pareto_sample(rows: DataFrame) -> DataFrame:
    """Rows with 0 < p < 1 in Pareto order: ``place`` from 1, and ``more``, 1 for exactly as many of a source as the sum of
    its probabilities, rounded."""
    odds = F.col("u") / (1 - F.col("u"))
    ranked = rows.withColumn("rank", odds * (1 - F.col("p")) / F.col("p"))
    placed = number_rows(ranked, ["source"], ["rank", "doc_id", "row"], "place")
    # Sums of millions of shares differ in their last digits from run to run; the rounding does not.
    share = F.sum(F.col("p").cast("decimal(38,18)"))
    wanted = rows.groupBy("source").agg(F.round(share).cast("long").alias("wanted"))
    return beside(placed, wanted, ["source"]).withColumn("more", (F.col("place") <= F.col("wanted")).cast("int")).drop("wanted")


def with_gap(chosen: DataFrame) -> DataFrame:
    """Add ``gap``: the words a source's copies still lack; below 0 what is too much."""
    held = chosen.groupBy("source").agg(F.sum(F.col("size") * F.col("more")).alias("held"))
    return beside(chosen, held, ["source"]).withColumn("gap", F.col("lacking") - F.col("held")).drop("held")


def changed(chosen: DataFrame, rows: DataFrame, by: int) -> DataFrame:
    """Take the given rows once more, or not after all."""
    more = F.col("more") + F.coalesce("_by", F.lit(0))
    marks = rows.select("row", F.lit(by).alias("_by"))
    return chosen.join(marks, "row", "left").withColumn("more", more).drop("_by", "gap")


def mix_sources(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken``: how often the mix holds each row of ``docs``."""
    plain = typed(docs, {"doc_id": "long", "source": "string", "text": "string"})
    return mix_rows(plain.withColumn("row", F.monotonically_increasing_id())).drop("row")


def mix_rows(plain: DataFrame) -> DataFrame:
    """What ``mix_sources`` returns and ``row``; ``plain`` has ``doc_id, source, text, row``."""
    stages = Stages(plain.sparkSession, "mixing")
    sized = stages.write(sizes(plain), "sizes")
    goals = stages.write(targets(sized), "targets")
    rows = beside(sized, goals, ["source", "known"])
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio + 1e-12)
    lacking = F.greatest(F.col("target") - whole * F.col("source_size"), F.lit(0.0))
    rows = rows.withColumns({"whole": whole.cast("long"), "lacking": F.when(lacking < 0.5, 0.0).otherwise(lacking)})
    rows = stages.write(inclusion(rows, stages), "inclusion")
    certain = rows.where("p >= 1").withColumns({"more": F.lit(1), "place": F.lit(0).cast("long")})
    out = rows.where("p <= 0").withColumns({"more": F.lit(0), "place": F.lit(None).cast("long")})
    drawn = pareto_sample(rows.where("p > 0 and p < 1"))
    names = [*rows.columns, "more", "place"]
    chosen = certain.select(*names).unionByName(drawn.select(*names))
    chosen = with_gap(stages.write(chosen, "ranked"))
    # Too few words: more documents in the order, those that fit. Too many: the last ones go, those that fit.
    keep = ["source", "place", "row", "size", "gap"]
    trial = chosen.where("place > 0").where("(gap > 0 and more = 0 and size <= gap) or (gap < 0 and more = 1 and size <= -gap)")
    trial = trial.select(*keep).withColumn("turn", F.when(F.col("gap") < 0, -F.col("place")).otherwise(F.col("place")))
    again = running_total(trial, ["source"], ["turn", "row"], "size", "late")
    fits = stages.write(again.where(F.col("late") + F.col("size") <= F.abs(F.col("gap"))), "fits")
    chosen = changed(changed(chosen, fits.where("gap > 0"), 1), fits.where("gap < 0"), -1)
    # The one document that comes nearest to what is missing then, if it brings the sum nearer.
    chosen = with_gap(stages.write(chosen, "chosen"))
    miss = F.abs(F.col("size") - F.col("gap"))
    nearest = chosen.where("more = 0 and size > 0").where(miss < F.col("gap"))
    last = nearest.groupBy("source").agg(F.min(F.struct(miss, "place", "row")).alias("best")).select(F.col("best.row").alias("row"))
    chosen = changed(chosen, last, 1)

    names = ["row", "doc_id", "source", "known", "size", "source_size", "target", "whole", "more"]
    copies = (F.col("whole") + F.col("more")).alias("copies")
    taken = ((F.col("whole") + F.col("more")) * F.col("size")).alias("taken")
    source = F.when(F.col("known"), F.col("source")).alias("source")
    every = chosen.select(*names).unionByName(out.select(*names))
    return every.select("row", "doc_id", source, "size", "source_size", "target", copies, taken)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix holds it."""
    numbered = as_rows(docs).withColumn("row", F.monotonically_increasing_id())
    numbered = Stages(docs.sparkSession, "mixing").write(numbered, "numbered")
    kinds = {"doc_id": "long", "source": "string", "text": "string"}
    plain = numbered.select("row", *[F.col("doc").getField(c).cast(kind).alias(c) for c, kind in kinds.items()])
    wanted = mix_rows(plain).where("copies > 0").select("row", F.col("copies").cast("int").alias("copies"))
    repeated = numbered.join(wanted, "row").select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return from_rows(repeated, docs.columns)
