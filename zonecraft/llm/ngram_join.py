"""N-gram Jaccard join with token-combination prefixes, and the groups its links form.

A document is the set of its distinct shingles of ``SHINGLE`` words. Shingles are put in one order for all documents:
rare ones by hash, then the ``FREQUENT`` most frequent ones by frequency. With similarity t = 4/5 two sets of n and m
shingles that link share at least 4n/5, so at most n//5 of the first set's shingles are missing from the other one.

Index. A document's prefix begins as its first n//5 + 1 shingles. A rare shingle in it is a signature of its own.
Frequent shingles are split by hash into groups; within a group each pair is a signature, a single shingle is not.
A group of c shingles can therefore lose c - 1 of them unseen, and the prefix is extended until rare shingles plus the
sum of (c - 1) reach n//5 + 1. Two linked sets then share a signature: in the prefix that ends first, the missing
shingles are too few to hit every rare one and all but one of each group. The number of groups follows the size class;
a document is indexed for its own class and that of the largest partner it can have, so partners meet in one.

Verification. Copies (equal sets) are one node. Each node is first compared with the centre it shares most signatures
with. Only nodes that share a signature and are still in different components are compared beyond that, so a group of
near copies costs comparisons in proportion to its size, and no link between components is missed. A centre is the
node of a signature with the smallest share of lone shingles: rare ones of its prefix that no other node has there.
Pairs whose link can be ruled out by counts alone are not compared. They go by the prefix that ends first in the order,
whose shingles are in the other prefix if they are in the other set: with q lone shingles the sets have at most n - q in
common, and of a prefix of rare shingles at most n - ceil(4 (n + m) / 9) are missing from the other set. (Sets whose
prefixes hold all their rare shingles both go first.) Nodes compared with the same centre know which of its shingles
they hold, as a bit map of its first ``BITS`` and a count of the others; what both hold of the centre plus what the
smaller one holds beside it bounds their overlap. The comparison counts common shingles of the whole sets.

Which shingles are frequent only changes costs, never results. Words are compared with A-Z in lower case, as 64-bit
hashes. NULL and empty texts have no shingles and form a component of their own. Rows that repeat a document id are
documents with the same id. Documents with a NULL id link like others; a component's id is its smallest id that is
not NULL. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecraft.llm.common import Stages, as_rows, from_rows, map_batches, typed
from zonecraft.llm.components import components
from zonecraft.llm.words import Words, blocks, mix, windows

SHINGLE = 5
FREQUENT = 100_000  # at most so many shingles count as frequent: 1.6 MB, whatever the input
FREQUENT_FROM = 24  # documents
COUNTED = 2_000_000  # shingles counted together in a task
BITS = 256  # shingles of a centre that its neighbours keep a bit map of
NODES = "doc_id long, own long, n long, node long"  # own: the hash of the text, which tells rows of one id apart
END = 2**63 - 1  # the place where a prefix ends that holds all rare shingles of its set


def shingle_sets(words: Words, width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a block."""
    hashes = words.hashes(lower=True)
    long, fits = windows(hashes, words.bounds, width)
    sets = []
    for first, end in zip(words.bounds[:-1], words.bounds[1:], strict=True):
        if end - first >= width:
            sets.append(np.unique(long[first : end - width + 1]))
        elif end > first:
            part, _ = windows(hashes[first:end], np.array([0, end - first]), int(end - first))
            sets.append(mix(part[:1] + np.uint64(end - first)))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def node_of(shingles: np.ndarray) -> int | None:
    """The identity of a set: equal sets and only they share it."""
    if not len(shingles):
        return None
    return int((mix(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))).view(np.int64))


def describe(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: documents with size and node, and shingles often met within one run of documents."""

    def often(sets: list[np.ndarray]) -> dict:
        tokens, counts = np.unique(np.concatenate(sets), return_counts=True)
        kept = counts >= 3
        n = int(kept.sum())
        return {"doc_id": pa.nulls(n), "own": pa.nulls(n), "n": counts[kept], "node": pa.nulls(n), "token": tokens[kept].view(np.int64)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        waiting, size = [], 0
        for batch in batches:
            for first, last, words in blocks(batch.column(1)):
                sets = shingle_sets(words)
                yield {
                    "doc_id": batch.column(0).slice(first, last - first),
                    "own": batch.column(2).slice(first, last - first),
                    "n": [len(s) for s in sets],
                    "node": [node_of(s) for s in sets],
                    "token": pa.nulls(len(sets)),
                }
                waiting += sets
                size += sum(map(len, sets))
                if size >= COUNTED:
                    yield often(waiting)
                    waiting, size = [], 0
        if waiting:
            yield often(waiting)

    return map_batches(docs.select("doc_id", "text", F.xxhash64("text").alias("own")), NODES + ", token long", work)


def frequent_shingles(described: DataFrame) -> np.ndarray:
    """The most frequent shingles, most frequent last; at most ``FREQUENT`` rows reach the driver."""
    counted = described.where("token is not null").groupBy("token").agg(F.sum("n").alias("n"))
    top = counted.where(F.col("n") >= FREQUENT_FROM).orderBy(F.desc("n"), "token").limit(FREQUENT).collect()
    return np.array([r.token for r in reversed(top)], np.int64).view(np.uint64)


def prefix_signatures(shingles: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of one set: rare shingles and pairs of frequent ones. ``frequent`` is sorted; ``rank`` is the order's."""
    n = len(shingles)
    need = n // 5 + 1
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
        common = frequent[at] == shingles
    else:
        common = np.zeros(n, bool)
    rare = shingles[~common][:need]
    if len(rare) == need:
        return rare, rare[:0]
    ordered = shingles[common][np.argsort(rank[at[common]])]
    found = [rare[:0]]
    for size_class in sorted({n.bit_length(), (n + n // 4).bit_length()}):
        groups = max(1, (1 << (size_class - 1)) // 8)
        group = (mix(ordered) % np.uint64(groups)).astype(np.int64)
        # A group's first shingle adds nothing to the count.
        adds = np.ones(len(ordered), np.int64)
        adds[np.unique(group, return_index=True)[1]] = 0
        end = int(np.searchsorted(len(rare) + np.cumsum(adds), need)) + 1
        tokens, group = ordered[:end], group[:end]
        by = np.argsort(group, kind="stable")
        tokens, group = tokens[by], group[by]
        for k in range(1, len(tokens)):
            same = group[k:] == group[:-k]
            if not same.any():
                break
            a, b = tokens[:-k][same], tokens[k:][same]
            found.append(mix(np.minimum(a, b) * np.uint64(3) + mix(np.maximum(a, b)) + np.uint64(size_class)))
    return rare, np.unique(np.concatenate(found))


def signatures(docs: DataFrame, frequent: Broadcast) -> DataFrame:
    """``signature, node, n, rare, last, single`` of every document with shingles: ``rare`` counts the rare shingles of
    its prefix, ``last`` is where it ends, ``single`` tells shingles from pairs. Copies within a task's recent rows are
    left out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        by_rank = frequent.value
        order = np.argsort(by_rank)
        known: set[int] = set()
        for batch in batches:
            for _, _, words in blocks(batch.column(1)):
                found, rows = [], []
                for shingles in shingle_sets(words):
                    node = node_of(shingles)
                    if node is None or node in known:
                        continue
                    if len(known) >= 100_000:
                        known.clear()
                    known.add(node)
                    rare, pairs = prefix_signatures(shingles, by_rank[order], order)
                    found += [rare, pairs]
                    last = int(rare[-1] >> np.uint64(1)) if len(rare) == len(shingles) // 5 + 1 else END
                    rows += [(node, len(shingles), len(rare), last, True), (node, len(shingles), len(rare), last, False)]
                if found:
                    sizes = [len(f) for f in found]
                    columns = [np.repeat(np.array(c), sizes) for c in zip(*rows, strict=True)]
                    named = dict(zip(("node", "n", "rare", "last", "single"), columns, strict=True))
                    yield {"signature": np.concatenate(found).view(np.int64)} | named

    return map_batches(docs, "signature long, node long, n long, rare long, last long, single boolean", work)


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, shingles`` (8 bytes each, sorted) of the nodes in ``wanted`` (node, doc_id, own): a row is found by its id
    and the hash of its text, so rows of one id or without one cost no more than others."""
    keys = wanted.withColumnsRenamed({"doc_id": "_id", "own": "_own"})
    marked = docs.withColumn("own", F.xxhash64("text"))
    same = marked["doc_id"].eqNullSafe(keys["_id"]) & (marked["own"] == keys["_own"])
    chosen = marked.join(keys, same).select("node", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for first, last, words in blocks(batch.column(1)):
                asked = batch.column(0).slice(first, last - first).to_pylist()
                # Texts of one hash are all but certainly equal; the node's own set decides.
                pairs = [(a, s) for a, s in zip(asked, shingle_sets(words), strict=True) if node_of(s) == a]
                yield {"node": [a for a, _ in pairs], "shingles": [s.tobytes() for _, s in pairs]}

    return map_batches(chosen, "node long, shingles binary", work)


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with the number of common shingles, whether they link (100 * intersection >= 80 * union), and which
    of b's shingles a holds: bit maps w0, w1, ... of the first ``BITS`` and the count ``beyond``."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "left", "right")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            common, linked, maps = [], [], []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                held = x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y
                count = int(held.sum())
                common.append(count)
                linked.append(100 * count >= 80 * (len(x) + len(y) - count))
                first = np.zeros(BITS, bool)
                first[: min(len(y), BITS)] = held[:BITS]
                maps.append(np.packbits(first).view("<i8"))
            if not common:
                continue
            maps = np.array(maps)
            words = {f"w{i}": maps[:, i] for i in range(BITS // 64)}
            seen = np.bitwise_count(maps.view(np.uint64)).sum(1)
            named = {"a": batch.column(0), "b": batch.column(1), "common": common, "linked": linked}
            yield named | words | {"beyond": np.array(common) - seen}

    words = ", ".join(f"{w} long" for w in WORDS)
    return map_batches(both, f"a long, b long, common long, linked boolean, {words}, beyond long", work)


WORDS = [f"w{i}" for i in range(BITS // 64)]
SIZES_FIT = "5 * least(n, m) >= 4 * greatest(n, m)"
# The least overlap of two sets that link: 4 (n + m) / 9, rounded up.
OVERLAP = "(4 * (n + m) + 8) div 9"
LONE_FITS = f"""{SIZES_FIT} and case when last < other_last then n - lone >= {OVERLAP}
    when other_last < last then m - other_lone >= {OVERLAP}
    when last = {END} then least(n - lone, m - other_lone) >= {OVERLAP}
    else greatest(n - lone, m - other_lone) >= {OVERLAP} end"""
# ``outside`` counts a node's shingles that are not the centre's, ``beside`` leaves out the lone ones among them, which
# count for nothing where both prefixes hold all rare shingles.
CENTRE_FITS = f"""coalesce(centre <> other_centre, true) or least(beyond, other_beyond)
    + if(last = {END} and other_last = {END}, least(beside, other_beside), least(outside, other_outside))
    + {' + '.join(f'bit_count({w} & other_{w})' for w in WORDS)} >= {OVERLAP}"""
PROFILE = ["centre", *WORDS, "beyond", "outside", "beside"]
# With c common signatures. A prefix that ends among the rare shingles has n // 5 + 1 of them.
COUNT_FITS = f"""case when last < other_last then c >= n div 5 + 1 - n + {OVERLAP}
    when other_last < last then c >= m div 5 + 1 - m + {OVERLAP} else true end"""
OTHER = ["node as b", "n as m", "last as other_last", "lone as other_lone"]
PAIR = ["a", "b", "n", "m", "last", "other_last"]


def shared_facts(postings: DataFrame) -> DataFrame:
    return postings.select("node", "n", "last", "lone").distinct()


def link_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    return linked_rows(docs).select("doc_id", "n_shingles", "component_id")


def linked_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, own, n_shingles, component_id, root`` for every row of ``docs``; rows without shingles have no root."""
    spark = docs.sparkSession
    stages = Stages(spark, "ngram")
    plain = typed(docs, {"doc_id": "long", "text": "string"})
    described = stages.write(describe(plain), "nodes")
    nodes = described.where("token is null").select("doc_id", "own", "n", "node")
    # A copy with an id stands for a node where there is one.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "own")).alias("first")
    firsts = nodes.where("node is not null").groupBy("node").agg(first).select("node", "first.doc_id", "first.own")

    def compared(pairs: DataFrame) -> DataFrame:
        """What the comparison of the pairs tells; whole sets are made for these documents only."""
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = sets_of(plain, ends.join(firsts, "node"))
        sets = stages.write(wanted.groupBy("node").agg(F.first("shingles").alias("shingles")), "sets")
        found = stages.write(compare(pairs, sets), "compared")
        stages.drop(sets)
        return found

    frequent = spark.sparkContext.broadcast(frequent_shingles(described))
    indexed = stages.write(signatures(plain, frequent), "signatures")
    shared = indexed.groupBy("signature").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    shared_rows = stages.write(indexed.join(shared.select("signature"), "signature", "left_semi").distinct(), "shared")
    stages.drop(indexed)
    lone = shared_rows.groupBy("node").agg((F.first("rare") - F.count_if("single")).alias("lone"))
    postings = stages.write(shared_rows.join(lone, "node"), "postings")
    stages.drop(shared_rows)

    # Each node with the centre it shares most signatures with.
    share = (F.col("lone") * 1000 / F.col("n")).cast("int").alias("share")
    centres = postings.groupBy("signature").agg(F.min(F.struct(share, "node", "n", "last", "lone")).alias("centre"))
    centres = centres.select("signature", "centre.*").selectExpr("signature", *OTHER)
    offered = postings.withColumnRenamed("node", "a").join(centres, "signature").where("a <> b").where(LONE_FITS)
    offered = offered.groupBy(*PAIR).agg(F.count("*").alias("c")).where(COUNT_FITS)
    best = offered.groupBy("a").agg(F.max(F.struct("c", "b", "other_last")).alias("best"))
    first_pairs = stages.write(best.select("a", "best.b", F.col("best.other_last").alias("centre_last")), "pairs")
    first = compared(first_pairs)
    first_links = first.where("linked").select("a", "b")
    roots = stages.write(components(first_links, stages), "roots")

    # What each node holds of its centre. Lone shingles are not the centre's where both prefixes hold all rare ones.
    facts = shared_facts(postings)
    own = first.drop("linked").join(first_pairs, ["a", "b"]).withColumnsRenamed({"a": "node", "b": "centre"})
    lone_beside = F.when((F.col("last") == END) & (F.col("centre_last") == END), F.col("lone")).otherwise(0)
    own = own.join(facts, "node").withColumn("outside", F.col("n") - F.col("common"))
    own = own.withColumn("beside", F.col("outside") - lone_beside)
    all_bits = [F.lit(-1).cast("long").alias(w) for w in WORDS]
    itself = own.select("centre").distinct().join(facts.withColumnRenamed("node", "centre"), "centre")
    beyond = F.greatest(F.col("n") - BITS, F.lit(0)).alias("beyond")
    none = [F.lit(0).cast("long").alias(c) for c in ("outside", "beside")]
    itself = itself.select(F.col("centre").alias("node"), "centre", *all_bits, beyond, *none)
    itself = itself.join(own.select("node"), "node", "left_anti")
    profiles = stages.write(own.select("node", *PROFILE).unionByName(itself), "profiles")

    # What is left: nodes with common signatures that are still apart.
    marked = postings.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    marked = marked.join(profiles, "node", "left")
    mixed = marked.groupBy("signature").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    open_rows = stages.write(marked.join(mixed.select("signature"), "signature", "left_semi"), "open")
    stages.drop(postings)
    other = open_rows.selectExpr("signature", *OTHER, "root as other_root", *[f"{c} as other_{c}" for c in PROFILE])
    apart = open_rows.withColumnRenamed("node", "a").join(other, "signature")
    apart = apart.where("a < b and root <> other_root").where(LONE_FITS).where(CENTRE_FITS).groupBy(*PAIR).agg(F.count("*").alias("c"))
    done = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = stages.write(apart.where(COUNT_FITS).select("a", "b").join(done, ["a", "b"], "left_anti"), "pairs")
    stages.drop(open_rows, first_pairs)
    more_links = compared(rest).where("linked").select("a", "b")

    joined = components(first_links.unionByName(more_links), stages)
    placed = firsts.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = stages.write(placed, "placed")
    smallest = placed.groupBy("root").agg(F.min("doc_id").alias("component"))
    component = placed.join(smallest, "root").select("node", "root", "component")
    return nodes.join(component, "node", "left").select(
        "doc_id", "own", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"), "root"
    )


def keep_one_per_component(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component: the one with the component's id, or one without an id where none has one.

    Different texts of one id that do not link are components of their own. Rows without shingles link with nothing; equal
    ones of one id, or without one, stay once.
    """
    found = Stages(docs.sparkSession, "ngram").write(linked_rows(docs), "components")
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "own")).alias("row")
    linked = found.where("root is not null").groupBy("root").agg(smallest).select("row.doc_id", "row.own")
    alone = found.where("root is null").select("doc_id", "own").distinct()
    kept = linked.unionByName(alone)
    text = F.col("doc").getField("text").cast("string")
    rows = as_rows(docs).withColumns({"id": F.col("doc").getField("doc_id").cast("long"), "hash": F.xxhash64(text), "text": text})
    chosen = rows.join(kept, rows["id"].eqNullSafe(kept["doc_id"]) & (rows["hash"] == kept["own"]), "left_semi")
    # Equal rows: Spark drops all but one of a task's before it shuffles them.
    rank = F.row_number().over(Window.partitionBy("id", "hash").orderBy("text"))
    return from_rows(chosen.withColumn("rank", rank).where("rank = 1"), docs.columns)
