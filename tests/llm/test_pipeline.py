"""The pipeline stage by stage against plain versions, and over awkward rows."""

from collections import Counter

import corpus_pipeline
from tests.llm import brute
from tests.llm.fixtures import document_rows, frame
from zonecraft.llm.common import Stages

SF = "/root/testdata/sf0.01"


def test_each_stage_on_what_the_one_before_kept(spark):
    stages = Stages(spark, "test")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stages.write(stage(spark, docs, SF), "out")
        seen.append(docs)
    source = spark.read.parquet(f"{SF}/documents.parquet")
    assert all(s.columns == source.columns for s in seen[:-1])
    ruled, single, clean, mixed = [[r.asDict() for r in s.collect()] for s in seen[:-1]]
    assert not any(brute.base_rules(r["text"])[-1] for r in ruled) and len(ruled) > 800
    components = brute.components([(r["doc_id"], r["text"]) for r in ruled])
    assert {r["doc_id"] for r in single} == {c for _, c in components.values()} and len(single) < len(ruled)
    assert [r["doc_id"] for r in sorted(clean, key=lambda r: r["doc_id"])] == sorted(r["doc_id"] for r in single)
    assert not any(brute.base_secrets(r["text"]) for r in clean)
    copies = Counter(r["doc_id"] for r in mixed)
    assert set(copies) <= {r["doc_id"] for r in clean} and max(copies.values()) <= 2
    sizes = {r["doc_id"]: len(brute.split(r["text"])) for r in clean}
    assert abs(sum(sizes[d] * c for d, c in copies.items()) - 1.5 * sum(sizes.values())) < 0.05 * sum(sizes.values())
    pieces = seen[-1].collect()
    whole = {}
    for p in pieces:
        whole[p.doc_id] = whole.get(p.doc_id, 0) + p.length
    assert all(whole[p.doc_id] == copies[p.doc_id] * p.doc_tokens for p in pieces) and set(whole) == set(copies)


def test_awkward_rows_pass_every_stage(spark):
    rows = document_rows() + [(None, None, None, None, None, "r", 0, "k", "p", "n"), (1, "x " * 60, "en", "s", 9, "r", 0, "k", "p", "n")]
    for given in (rows, []):
        stages, docs = Stages(spark, "test"), frame(spark, given)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            following = stages.write(stage(spark, docs, SF), "out")
            assert following.columns == docs.columns
            docs = following
        assert stages.write(corpus_pipeline.STAGES[-1][1](spark, docs, SF), "out").count() >= 0
