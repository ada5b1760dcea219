"""Word hashes of blocks of any size, against plain versions: also blocks with fewer words than a window."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tests.llm import brute
from tests.llm.fixtures import document_rows, frame, words
from zonecraft.llm import ngram_join, suffix_repeats
from zonecraft.llm.words import blocks, windows

TEXTS = st.lists(st.lists(st.sampled_from("ab"), max_size=14).map(" ".join), min_size=1, max_size=4)


def block_of(texts):
    ((first, last, found),) = blocks(pa.array(texts))
    assert (first, last) == (0, len(texts))
    return found


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 13))
def test_windows_tell_runs_of_words_apart(texts, width):
    found = block_of(texts)
    value, inside = windows(found.hashes(), found.bounds, width)
    plain = []
    for text in texts:
        w = text.split()
        plain += [tuple(w[j : j + width]) if j + width <= len(w) else None for j in range(len(w))]
    assert inside.tolist() == [p is not None for p in plain]
    names = {}
    for p, v in zip(plain, value.tolist(), strict=True):
        if p is not None:
            assert names.setdefault(p, v) == v
    assert len(set(names.values())) == len(names)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_anchors_contents_and_shingles_of_short_blocks(texts):
    found = block_of(texts)
    hashes = found.hashes()
    value, inside = suffix_repeats.anchors(hashes, found.bounds)
    gram, _ = windows(hashes, found.bounds, suffix_repeats.GRAM)
    for j in np.flatnonzero(inside):
        assert value[j] == gram[j : j + suffix_repeats.WINDOW - suffix_repeats.GRAM + 1].min()
    whole = dict(zip(texts, suffix_repeats.contents(hashes, found.bounds).tolist(), strict=True))
    assert len(set(whole.values())) == len({tuple(t.split()) for t in texts})
    sets = [{tuple(s) for s in brute.shingles(t)} for t in texts]
    assert [len(s) for s in ngram_join.shingle_sets(found)] == [len(s) for s in sets]
    for a, x in zip(sets, ngram_join.shingle_sets(found), strict=True):
        for b, y in zip(sets, ngram_join.shingle_sets(found), strict=True):
            assert len(a & b) == len(np.intersect1d(x, y))


@pytest.mark.parametrize("count", [1, 2, 3, 5, 6, 12])
def test_a_last_row_of_few_words(spark, count):
    """1,001 rows in one partition: the last row is a block of its own."""
    import random

    rng = random.Random(count)
    shared = words(rng, 30)
    rows = [(i, f"{words(rng, 8, 10**6)} {shared if i % 50 == 0 else ''}", "", "", 0, "", 0, "", "", "") for i in range(1000)]
    rows.append((1000, words(rng, count), "", "", 0, "", 0, "", "", ""))
    docs = frame(spark, rows).coalesce(1).orderBy("doc_id")
    plain = [(r[0], r[1]) for r in rows]
    linked = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link_documents(docs).collect()}
    assert linked == brute.components(plain)
    found = {r.doc_id: (r.n_words, r.n_removed) for r in suffix_repeats.remove_repeats(docs).collect()}
    assert found == {i: (a, b) for i, (a, b, _) in brute.without_repeats(plain).items()}


def test_stages_keep_columns_of_any_name(spark):
    """Every name that a stage uses inside may be a column of the caller."""
    names = "_own _rank _kept _kept_own _row _time _copies _id id hash rank own doc row copies col size u known source_size target".split()
    from pyspark.sql import functions as F

    rows = [r for r in document_rows() if r[1] and len(r[1]) < 2000]
    docs = frame(spark, rows).drop("row").withColumns({n: F.concat(F.lit(f"own {n} "), "doc_id") for n in names})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, "/root/testdata/sf0.001")
        assert got.columns == docs.columns and got.dtypes == docs.dtypes
        assert all(r[n] == f"own {n} {r.doc_id}" for r in got.collect() for n in names)
