"""The n-gram join and the removal of repeats against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.fixtures import document_rows, edited, frame, words
from zonecraft.llm import ngram_join, suffix_repeats
from zonecraft.llm.common import Stages
from zonecraft.llm.components import components


def plain(rows):
    return [(r[0], r[1]) for r in rows]


def joined(spark, rows):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link_documents(frame(spark, rows)).collect()}


def test_components_of_awkward_rows(spark):
    rows = document_rows()
    assert joined(spark, rows) == brute.components(plain(rows))


@pytest.mark.parametrize("frequent", [3, 8])
def test_frequent_shingles_change_nothing(spark, monkeypatch, frequent):
    """Near copies of a few texts and shared passages, with most shingles counted as frequent."""
    monkeypatch.setattr(ngram_join, "FREQUENT_FROM", frequent)
    rng = random.Random(frequent)
    bases = [words(rng, n) for n in (8, 12, 40, 90, 330)]
    texts = [edited(rng, b, rng.randrange(0, 1 + len(b) // 60)) for b in (rng.choice(bases) for _ in range(400))]
    texts += [b + " " + bases[0] for b in (words(rng, 20) for _ in range(20))]
    rows = [(i, t, "", "", 0, "", 0, "", "", "") for i, t in enumerate(texts)]
    described = ngram_join.describe(frame(spark, rows).select("doc_id", "text"))
    assert len(ngram_join.frequent_shingles(described)) > 50
    want = brute.components(plain(rows))
    assert joined(spark, rows) == want and 20 < len({c for _, c in want.values()}) < 300


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(3)
    frequent = np.sort(rng.integers(1, 2**63, 400).astype(np.uint64))
    rank = rng.permutation(400)
    for _ in range(400):
        n = int(rng.integers(2, 120))
        common = rng.choice(frequent, min(n, int(rng.integers(0, n + 1))), replace=False)
        x = np.unique(np.concatenate([common, rng.integers(1, 2**63, n - len(common)).astype(np.uint64)]))
        drop = int(rng.integers(0, len(x) // 5 + 1))
        y = rng.permutation(x)[drop:]
        more = int(rng.integers(0, max(int(1.25 * len(y)) - len(x), 0) + 1))
        y = np.unique(np.concatenate([y, rng.integers(1, 2**63, more).astype(np.uint64)]))
        overlap = len(np.intersect1d(x, y))
        if min(len(x), len(y)) > 1 and 100 * overlap >= 80 * (len(x) + len(y) - overlap):
            a, b = (np.concatenate(ngram_join.prefix_signatures(s, frequent, rank)) for s in (x, y))
            assert len(np.intersect1d(a, b))


def test_null_and_repeated_ids(spark):
    text = "a b c d e f g h"
    rows = [(i, t, "", "", 0, "", 0, "", "", "") for i, t in [(None, text), (4, text), (4, text), (2, "A B C D E F G H"), (None, "")]]
    got = ngram_join.link_documents(frame(spark, rows)).collect()
    pairs = sorted((str(r.doc_id), str(r.component_id)) for r in got)
    assert pairs == [("2", "2"), ("4", "2"), ("4", "2"), ("None", "2"), ("None", "None")]
    kept = ngram_join.keep_one_per_component(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("2", "A B C D E F G H"), ("None", "")]


def test_rows_without_an_id_go_with_their_component(spark):
    """Near copies without an id of a kept document go; of a component without ids one row stays; ids cost no more than none."""
    rng = random.Random(11)
    base, other = words(rng, 60), words(rng, 60)
    texts = [(9, base), (None, edited(rng, base, 1)), (None, base), (None, base), (None, other), (None, edited(rng, other, 1)), (None, other)]
    rows = [(i, t, "", "", 0, "", 0, "", "", "") for i, t in texts]
    kept = ngram_join.keep_one_per_component(frame(spark, rows)).collect()
    assert [r.text for r in kept if r.doc_id == 9] == [base] and len(kept) == 2


def test_sets_of_rows_without_an_id_are_made_once(spark):
    """1,500 near copies without an id: each wanted set is found by id and text, not by all pairs of rows."""
    rng = random.Random(12)
    base = words(rng, 80)
    rows = [(None, edited(rng, base, 2), "", "", 0, "", 0, "", "", "") for _ in range(1500)]
    docs = frame(spark, rows).select(F.col("doc_id"), "text")
    marked = docs.withColumn("own", F.xxhash64("text")).withColumn("node", F.monotonically_increasing_id())
    plan = ngram_join.sets_of(docs, marked.select("node", "doc_id", "own"))
    assert plan.count() == 0  # nodes of other names than the sets' own: every row met, none kept
    joined = docs.withColumn("own", F.xxhash64("text")).join(marked.select("own"), "own").count()
    assert joined < 1600


def test_different_texts_of_one_id_are_kept_by_their_own_components(spark):
    rng = random.Random(7)
    a, b, c, d = (words(rng, 30, 10**6) for _ in range(4))
    texts = [(5, a), (5, b), (5, b), (3, c), (5, c), (6, d), (6, d.upper()), (7, ""), (7, a), (8, b)]
    rows = [(i, t, "", "", 0, "", 0, "", "", "") for i, t in texts]
    kept = ngram_join.keep_one_per_component(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.text.lower()) for r in kept) == sorted([(5, a), (5, b), (3, c), (6, d), (7, "")])


def test_empty_table(spark):
    assert ngram_join.link_documents(frame(spark, [])).count() == 0
    assert suffix_repeats.remove_repeats(frame(spark, [])).count() == 0


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 40)] + [(7, 7)]
    found = components(spark.createDataFrame(edges, "a long, b long"), Stages(spark, "test")).collect()
    roots = {r.node: r.root for r in found}
    assert {roots[i] for i in range(61)} == {0} and {roots[1000 + i] for i in range(40)} == {1000}


def removed(spark, rows):
    import hashlib

    found = suffix_repeats.remove_repeats(frame(spark, rows)).collect()
    for r in found:
        assert sum(s.end - s.first for s in r.removed) == r.n_removed
    return {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in found}


@pytest.mark.parametrize("heavy", [0, 4])
def test_repeats_of_awkward_rows(spark, monkeypatch, heavy):
    """Also with every prefix heavy, so that each window is a group of its own."""
    monkeypatch.setattr(suffix_repeats, "HEAVY", heavy)
    rng = random.Random(2)
    rows = document_rows(2)
    passage = words(rng, 20)
    rows += [(900 + i, f"{words(rng, 5)} {passage} {words(rng, 14)}", "", "", 0, "", 0, "", "", "") for i in range(30)]
    want = brute.without_repeats(plain(rows))
    assert sum(n for _, n, _ in want.values()) > 500
    assert removed(spark, rows) == want


def test_rows_of_one_id_do_not_repeat_each_other(spark):
    text = words(random.Random(5), 30)
    rows = [(i, text, "", "", 0, "", 0, "", "", "") for i in (3, 3, 8, None)]
    found = suffix_repeats.remove_repeats(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in found) == [("3", 0), ("3", 0), ("8", 30), ("None", 30)]


def test_rows_of_one_id_are_judged_each_by_their_own_words(spark):
    """Only one of the rows without an id, and of those of id 5, is a copy; the others lose what they share, no more."""
    rng = random.Random(6)
    a, b, c, d, e = (words(rng, 30, 10**6) for _ in range(5))
    texts = [(1, a), (2, b), (None, a), (None, c), (None, f"{d} {a}"), (5, b), (5, e), (None, c)]
    rows = [(i, t, "", "", 0, "", 0, "", "", "") for i, t in texts]
    found = suffix_repeats.remove_repeats(frame(spark, rows)).collect()
    want = [(1, a), (2, b), (None, ""), (None, c), (None, d), (5, ""), (5, e), (None, c)]
    assert sorted((str(r.doc_id), r.kept_text) for r in found) == sorted((str(i), t) for i, t in want)
