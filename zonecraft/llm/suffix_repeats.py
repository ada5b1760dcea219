"""Removal of repeated passages by prefix-partitioned suffix trees.

A suffix starts at each word; the tree is needed to the depth of ``WINDOW`` words. A node at that depth with suffixes
of more than one document is a repeat; where such nodes follow each other along a document they are one maximal repeat.

1. Candidates. Every window has an anchor, the smallest hash among its ``GRAM``-word runs, so equal windows have equal
   anchors, and there is about one anchor for four windows. Only windows whose anchor occurs in documents of different
   content can repeat; the others are never shuffled. Exact copies of a document are known by a hash of all words: the
   later ones are removed whole and take no part in the rest.
2. Prefixes. The remaining suffixes are split into groups by their first ``DEPTHS[0]`` words. Where that prefix is
   heavy (counted for all suffixes in ``BUCKETS`` hash buckets), by their first ``DEPTHS[1]`` words, and where this is
   heavy too, by all words of the window.
3. Subtrees. A group's suffixes are sorted, so a node's suffixes lie together and its first one is that of the smallest
   document; the others are repeats. A group that is one full window is a single leaf: its smallest document is an
   aggregate, combined before the shuffle, so a passage in any share of the documents loads no single task.
4. Each document drops the words of its repeated windows.

Words and windows are compared by 64-bit hashes. NULL and empty texts have no words. Documents with a NULL id come
after all others and do not repeat each other. Rows that share a document id do not repeat each other either. The place
of a row (its id) only orders; a row is known by its place and the hash of its text, so rows of one id are judged each by
their own words. A text of fewer words than a window loses nothing. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecraft.llm.common import Stages, map_batches, typed
from zonecraft.llm.words import Words, blocks, fits, mix, powers, windows

WINDOW = 13
GRAM = 6
DEPTHS = (4, 8)
BUCKETS = 4096
HEAVY = 4  # times the mean of the buckets
LAST = 2**63 - 1  # the place of documents without an id
ROW = ["place", "own"]  # what a row is known by: its place and the hash of its text
DESCRIBED = "kind int, place long, own long, content long, value long, n long"
DOCUMENT, ANCHOR, PREFIX = 0, 1, 2


def anchors(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word: anchor of the window that starts there, and whether that window stays inside its text."""
    least, _ = windows(hashes, bounds, GRAM)
    runs, reach = WINDOW - GRAM + 1, 1
    while reach < runs:  # smallest of the next 2, 4, 8 runs
        step = min(reach, runs - reach)
        ahead = least[step:]
        least[: len(ahead)] = np.minimum(least[: len(ahead)], ahead)
        reach += step
    return least, fits(bounds, len(hashes), WINDOW)


def contents(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One hash per text of its whole word sequence."""
    up, down = powers(len(hashes) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[: len(hashes)], dtype=np.uint64)])
    own = (total[bounds[1:]] - total[bounds[:-1]]) * down[bounds[:-1]]
    return mix(own + np.diff(bounds).astype(np.uint64))


def describe(docs: DataFrame) -> DataFrame:
    """One pass over the texts: documents with the hash of their content, their anchors, and counts of prefixes."""

    def rows(kind: int, **columns) -> dict:
        size = max(map(len, columns.values()))
        fill = lambda name: columns.get(name, np.zeros(size, np.int64))
        return {"kind": np.full(size, kind), **{name: fill(name) for name in (*ROW, "content", "value", "n")}}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        prefixes = np.zeros((len(DEPTHS), BUCKETS), np.int64)
        for batch in batches:
            places, owns = (batch.column(c).to_numpy() for c in (0, 1))
            for first, last, words in blocks(batch.column(2)):
                hashes = words.hashes()
                content = contents(hashes, words.bounds).view(np.int64)
                place, own = places[first:last], owns[first:last]
                yield rows(DOCUMENT, place=place, own=own, content=content, n=words.counts)
                value, inside = anchors(hashes, words.bounds)
                for d, depth in enumerate(DEPTHS):
                    prefix, _ = windows(hashes, words.bounds, depth)
                    prefixes[d] += np.bincount((prefix[inside] % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
                found, text = [], []
                for i, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:] - WINDOW + 1, strict=True)):
                    if b > a:
                        distinct = np.unique(value[a:b])
                        found.append(distinct)
                        text.append(np.full(len(distinct), i))
                if found:
                    text = np.concatenate(text)
                    anchor = np.concatenate(found).view(np.int64)
                    yield rows(ANCHOR, place=place[text], own=own[text], content=content[text], value=anchor)
        for d in range(len(DEPTHS)):
            yield rows(PREFIX, place=np.full(BUCKETS, d), value=np.arange(BUCKETS), n=prefixes[d])

    return map_batches(docs.select(*ROW, "text"), DESCRIBED, work)


def heavy_prefixes(described: DataFrame) -> np.ndarray:
    """Which buckets hold far more suffixes than the others, per depth: two fixed tables of ``BUCKETS`` flags."""
    counts = np.zeros((len(DEPTHS), BUCKETS), np.int64)
    sums = described.where(F.col("kind") == PREFIX).groupBy("place", "value").agg(F.sum("n").alias("n"))
    for row in sums.collect():  # BUCKETS * len(DEPTHS) rows at most
        counts[row.place, row.value] = row.n
    return counts > HEAVY * counts.mean(1, keepdims=True)


def suffixes(candidates: DataFrame, heavy: np.ndarray) -> DataFrame:
    """``depth, route, suffix, place, own``: the distinct windows of each row whose anchor is in its list."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            places, owns = (batch.column(c).to_numpy() for c in (0, 1))
            lists = batch.column(3)
            for first, last, words in blocks(batch.column(2)):
                hashes = words.hashes()
                value, inside = anchors(hashes, words.bounds)
                whole, _ = windows(hashes, words.bounds, WINDOW)
                prefix = [windows(hashes, words.bounds, d)[0] for d in DEPTHS]
                chosen, text = [], []
                for i, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:] - WINDOW + 1, strict=True)):
                    if b <= a:
                        continue
                    wanted = np.sort(lists[first + i].values.to_numpy(zero_copy_only=False).view(np.uint64))
                    at = np.minimum(np.searchsorted(wanted, value[a:b]), len(wanted) - 1)
                    starts = a + np.flatnonzero(wanted[at] == value[a:b])
                    starts = starts[np.unique(whole[starts], return_index=True)[1]]
                    chosen.append(starts)
                    text.append(np.full(len(starts), first + i))
                if not chosen:
                    continue
                at, text = np.concatenate(chosen), np.concatenate(text)
                deep = [heavy[d][(prefix[d][at] % np.uint64(BUCKETS)).astype(np.int64)] for d in range(len(DEPTHS))]
                route = np.where(deep[0], np.where(deep[1], whole[at], prefix[1][at]), prefix[0][at])
                yield {
                    "depth": np.where(deep[0], np.where(deep[1], WINDOW, DEPTHS[1]), DEPTHS[0]),
                    "route": route.view(np.int64),
                    "suffix": whole[at].view(np.int64),
                    "place": places[text],
                    "own": owns[text],
                }

    return map_batches(candidates, "depth int, route long, suffix long, place long, own long", work)


def subtrees(grouped: DataFrame) -> DataFrame:
    """``place, own, suffix`` of repeats. Rows come sorted by group, suffix and place: a node's first row is its smallest."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        node, smallest = None, None
        for batch in batches:
            suffix, place = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            opens = np.ones(len(suffix), bool)
            opens[1:] = suffix[1:] != suffix[:-1]
            if len(suffix) and node == suffix[0]:
                opens[0] = False
            head = np.maximum.accumulate(np.where(opens, np.arange(len(suffix)), -1))
            least = np.where(head < 0, 0 if smallest is None else smallest, place[np.maximum(head, 0)])
            repeat = place > least
            yield {"place": place[repeat], "own": batch.column(2).to_numpy()[repeat], "suffix": suffix[repeat]}
            if len(suffix):
                node, smallest = suffix[-1], least[-1]

    return map_batches(grouped.select("suffix", *ROW), "place long, own long, suffix long", work)


def repeats(docs: DataFrame, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """Repeated windows per row (``place, own, suffixes``), and the rows that are later copies of whole documents."""
    described = stages.write(describe(docs), "described")
    documents = described.where(F.col("kind") == DOCUMENT).where(F.col("n") >= WINDOW)
    firsts = documents.groupBy("content").agg(F.min("place").alias("first"))
    copies = documents.join(firsts, "content").where("place > first").select(*ROW).distinct()
    copies = stages.write(copies, "copies")

    anchored = described.where(F.col("kind") == ANCHOR)
    shared = anchored.groupBy("value").agg(F.min("content").alias("a"), F.max("content").alias("b")).where("a <> b")
    shared = stages.write(shared.select("value"), "shared")
    lists = (
        anchored.select("value", *ROW)
        .join(shared, "value", "left_semi")
        .groupBy(*ROW)
        .agg(F.collect_set("value").alias("anchors"))  # bounded by the length of a document
        .join(copies, ROW, "left_anti")
    )
    lists = stages.write(lists, "candidates")
    stages.drop(shared)

    candidates = docs.join(lists, ROW).select(*ROW, "text", "anchors")
    found = stages.write(suffixes(candidates, heavy_prefixes(described)), "suffixes")
    stages.drop(described)
    grouped = found.where(F.col("depth") < WINDOW).repartition("route").sortWithinPartitions("route", "suffix", "place")
    leaves = found.where(F.col("depth") == WINDOW)
    smallest = leaves.groupBy("suffix").agg(F.min("place").alias("a"), F.max("place").alias("b")).where("a < b")
    hot = leaves.join(smallest, "suffix").where("place > a").select(*ROW, "suffix")
    marks = subtrees(grouped).unionByName(hot).groupBy(*ROW).agg(F.collect_set("suffix").alias("suffixes"))
    marks = stages.write(marks, "marks")
    stages.drop(found)
    return marks, copies


def covered(words: Words, whole: np.ndarray, text: int, marked: np.ndarray) -> np.ndarray:
    """Which words of a text lie in a marked window."""
    a, b = words.bounds[text], words.bounds[text + 1]
    hit = np.zeros(b - a + 1, np.int64)
    starts = np.flatnonzero(np.isin(whole[a : b - WINDOW + 1], marked))
    hit[starts] += 1
    hit[starts + WINDOW] -= 1
    return np.cumsum(hit)[:-1] > 0


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, removed`` (first and end word of each maximal repeat) and ``kept_text``."""
    stages = Stages(docs.sparkSession, "suffixes")
    plain = typed(docs, {"doc_id": "long", "text": "string"})
    placed = plain.withColumns({"place": F.coalesce("doc_id", F.lit(LAST)), "own": F.xxhash64("text")})
    marks, copies = repeats(placed, stages)
    joined = (
        placed.join(marks, ROW, "left")
        .join(copies.withColumn("copy", F.lit(True)), ROW, "left")
        .select("doc_id", "text", "suffixes", F.col("copy").isNotNull().alias("copy"))
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            lists, copied = batch.column(2), batch.column(3).to_pylist()
            for first, last, words in blocks(batch.column(1)):
                raw = words.data.tobytes()
                whole = None
                kept, removed, spans = [], [], []
                for i, n in enumerate(words.counts.tolist()):
                    own = raw[words.offsets[i] : words.offsets[i + 1]].split()
                    marked = lists[first + i]
                    gone = None
                    if copied[first + i] and n >= WINDOW:
                        gone = np.ones(n, bool)
                    elif marked.is_valid:
                        if whole is None:
                            whole, _ = windows(words.hashes(), words.bounds, WINDOW)
                        gone = covered(words, whole, i, marked.values.to_numpy(zero_copy_only=False).view(np.uint64))
                    if gone is not None:
                        own = list(compress(own, (~gone).tolist()))
                        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                        spans.append([{"first": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()])
                    else:
                        spans.append([])
                    kept.append(b" ".join(own).decode())
                    removed.append(n - len(own))
                yield {
                    "doc_id": batch.column(0).slice(first, last - first),
                    "n_words": words.counts,
                    "n_removed": removed,
                    "removed": spans,
                    "kept_text": kept,
                }

    schema = "doc_id long, n_words long, n_removed long, removed array<struct<first:long,end:long>>, kept_text string"
    return map_batches(joined, schema, work)
