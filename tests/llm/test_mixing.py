"""Mixing: targets by water filling, words near them, and the copies of the pipeline."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm import brute
from tests.llm.fixtures import document_rows, frame
from zonecraft.llm import mixing
from zonecraft.llm.common import Stages


def goals(sizes):
    """Targets by repeated sharing, as the contract words it."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {n: mixing.WEIGHTS[i % 3] for i, n in enumerate(names)}
    whole, full = 1.5 * sum(sizes.values()), set()
    while True:
        free = [n for n in names if n not in full]
        level = (whole - sum(2 * sizes[n] for n in full)) / sum(weight[n] for n in free) if free else 0
        above = {n for n in free if level * weight[n] > 2 * sizes[n]}
        if not above:
            return {n: 2 * sizes[n] if n in full else level * weight[n] for n in names}
        full |= above


def many_rows():
    rows = []
    for i in range(900):
        source = [None, "a", "b", "ä", "c", "empty"][i % 6]
        text = "" if source == "empty" else " ".join(["w"] * (1 + i * 7 % 90))
        rows.append((i, text, "", source, 0, "", 0, "", "", ""))
    return rows


@pytest.mark.parametrize("rows", [document_rows(), many_rows()], ids=["awkward", "many"])
def test_targets_and_words(spark, rows):
    found = mixing.mix_sources(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    sizes, sources = {}, defaultdict(int)
    for doc_id, text, _, source, *_ in rows:
        sizes[doc_id] = len(brute.split(text))
        sources[source] += sizes[doc_id]
    want, taken = goals(sources), defaultdict(int)
    for r in found:
        assert r.size == sizes[r.doc_id] and r.source_size == sources[r.source]
        assert r.target == pytest.approx(want[r.source]) and r.taken == r.copies * r.size <= 2 * r.size
        taken[r.source] += r.taken
    for source, words in taken.items():
        # What is missing is less than the shortest document that could still be added would overshoot.
        longest = max(r.size for r in found if r.source == source)
        assert abs(words - want[source]) <= longest
        if len(rows) > 500:
            assert abs(words - want[source]) <= 0.01 * sources[source]


def test_reruns_and_partitions_agree(spark):
    rows = many_rows()
    first = {tuple(r) for r in mixing.mix_sources(frame(spark, rows, 1)).collect()}
    assert first == {tuple(r) for r in mixing.mix_sources(frame(spark, rows[::-1], 7)).collect()}


def test_copies_are_rows(spark):
    rows = document_rows()
    docs = frame(spark, rows)
    copies = {r.doc_id: r.copies for r in mixing.mix_sources(docs).collect()}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({d: c for d, c in copies.items() if c})


def test_null_and_repeated_ids(spark):
    rows = [(i, "a b c", "", s, 0, "", 0, "", "", "") for i, s in [(None, "a"), (None, "a"), (1, "a"), (1, "a"), (2, None)]]
    found = mixing.mix_sources(frame(spark, rows)).collect()
    assert len(found) == 5 and sum(r.size for r in found) == 15
    assert mixing.mixed_documents(frame(spark, rows)).count() >= 5


def test_rows_without_an_own_id_are_mixed_each_by_itself(spark):
    """No ids, one id for all, and equal rows: the mix holds as many words of each source as its copies say."""
    rows = [(None, f"n{i} " * (1 + i % 7), "", "abc"[i % 3], 0, "", 0, "", "", "") for i in range(240)]
    rows += [(5, f"m{i} " * (1 + i % 5), "", "abc"[i % 3], 0, "", 0, "", "", "") for i in range(60)]
    rows += [(None, "same text", "", "c", 0, "", 0, "", "", "") for _ in range(30)]
    found, held = defaultdict(int), defaultdict(int)
    for r in mixing.mix_sources(frame(spark, rows)).collect():
        found[r.source] += r.taken
        assert r.target < 0.9 * r.source_size or r.target > 1.1 * r.source_size
    for r in mixing.mixed_documents(frame(spark, rows)).collect():
        held[r.source] += len(brute.split(r.text))
    assert held == found


def test_empty_table(spark):
    assert mixing.mix_sources(frame(spark, [])).count() == 0
    assert mixing.mixed_documents(frame(spark, [])).count() == 0


ROWS = "row long, doc_id long, source string, size long, lacking double, u double"


def plain_inclusion(sizes, lacking):
    """The level by bisection."""
    sizes = np.array(sizes, float)
    low, high = 0.0, 1e9
    for _ in range(300):
        level = (low + high) / 2
        words = (np.minimum(level * sizes**mixing.TILT, 1) * sizes)[sizes > 0].sum()
        low, high = (level, high) if words < lacking else (low, level)
    return np.where(sizes > 0, np.minimum(low * sizes**mixing.TILT, 1), 0) if lacking > 0 else np.zeros(len(sizes))


def test_inclusion_probabilities(spark):
    """They grow with the document, are 1 for those that are certain, and the expected words are those lacking."""
    rng = random.Random(3)
    kinds = {"even": [10] * 50, "mixed": [rng.randrange(0, 200) for _ in range(300)], "hot": [5] * 200 + [9000, 4000, 0], "one": [7]}
    lacking = {"even": 123.0, "mixed": 9000.5, "hot": 12_800.0, "one": 3.0}
    lacking["none"], kinds["none"] = 0.0, [3, 4]
    rows = [(f"{n}{i}", n, s) for n, sizes in kinds.items() for i, s in enumerate(sizes)]
    df = spark.createDataFrame([(k, k, n, s, lacking[n], 0.5) for k, (_, n, s) in enumerate(rows)], ROWS)
    got = {r.row: r.p for r in mixing.inclusion(df, Stages(spark, "test")).collect()}
    for name, sizes in kinds.items():
        mine = [got[k] for k, (_, n, _) in enumerate(rows) if n == name]
        assert mine == pytest.approx(plain_inclusion(sizes, lacking[name]), abs=1e-9)
        assert np.dot(mine, sizes) == pytest.approx(lacking[name])
    assert max(got[k] for k, (_, n, s) in enumerate(rows) if n == "hot" and s > 1000) == 1


def test_frequencies_over_many_draws(spark):
    """Each draw has exactly the expected number of documents; each document is drawn about as often as its probability says."""
    rng = random.Random(4)
    draws, p = 400, [0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9, 0.85] * 5
    schema = "row long, doc_id long, source string, size long, u double, p double"
    rows = [(d * 100 + i, i, f"d{d}", 5, rng.random(), q) for d in range(draws) for i, q in enumerate(p)]
    got = mixing.pareto_sample(spark.createDataFrame(rows, schema)).where("more = 1").select("source", "doc_id").collect()
    assert set(Counter(r.source for r in got).values()) == {round(sum(p))}
    seen = Counter(r.doc_id for r in got)
    for i, q in enumerate(p):
        assert abs(seen[i] / draws - q) < 4.5 * (q * (1 - q) / draws) ** 0.5 + 0.01
