"""Quality rules: fixed rules, and a calibrated n-gram classifier with a fixed threshold.

The classifier is a logistic regression on hashed n-grams: words, pairs of neighbouring words (a word that repeats the
one before it counts as one and the same pair), characters and runs of three, each kind as shares of its total in
``1 << BUCKET_BITS`` buckets. It learns from at most ``TRAINING_ROWS`` labelled rows outside the held-out fold; of these
one in ``CALIBRATION`` is kept back to turn the model's sums into probabilities (Platt scaling). A document is kept if no
rule fails and its probability reaches ``KEEP_FROM``. Every text is scored whole.

Rules: fewer than ``LEAST_WORDS`` words, or more than half of the words in three-word windows that are found twice.

NULL and empty texts have no words and fail. Without labels of both kinds the rules alone decide (probability NULL).
Rows are independent of each other: ties, repeated rows and NULL ids change nothing. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from zonecraft.llm.common import map_batches, typed
from zonecraft.llm.labelled import labelled_sample
from zonecraft.llm.text_stats import CONTINUES, base_counts
from zonecraft.llm.words import Words, blocks, mix

TRAINING_ROWS = 2000
BLOCK_ROWS = 200  # training rows that are worked on at a time
CALIBRATION = 5
BUCKET_BITS = 14
LEAST_WORDS = 50
KEEP_FROM = 0.5
STEPS = 300
RIDGE = 1e-5
KINDS = 4


def grams(words: Words, hashes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram: its bucket and its text, over a block."""
    texts = len(words.counts)
    shift = np.uint64(64 - BUCKET_BITS)
    of_word = np.repeat(np.arange(texts), words.counts)
    single = mix(hashes ^ np.uint64(0x51)) >> shift
    inner = of_word[1:] == of_word[:-1]
    pair = np.where(hashes[1:] == hashes[:-1], np.uint64(7), hashes[:-1] * np.uint64(3) + hashes[1:])
    pair = mix(pair ^ np.uint64(0x52)) >> shift
    letters = np.frombuffer(words.data.tobytes().decode().encode("utf-32-le"), "<u4").astype(np.uint64)
    first = np.concatenate([[0], np.cumsum(~CONTINUES[words.data])])[words.offsets]
    of_letter = np.repeat(np.arange(texts), np.diff(first))
    code = letters[:-2] << np.uint64(42) | letters[1:-1] << np.uint64(21) | letters[2:]
    triple = mix(code ^ np.uint64(0x53)) >> shift
    close = of_letter[2:] == of_letter[:-2]
    letter = mix(letters ^ np.uint64(0x54)) >> shift
    return [(letter.astype(np.int64), of_letter), (single.astype(np.int64), of_word), (pair.astype(np.int64)[inner], of_word[1:][inner]), (triple.astype(np.int64)[close], of_letter[2:][close])]


def sums(words: Words, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The model's sum for each text of a block."""
    texts = len(words.counts)
    out = np.full(texts, weights[-1])
    for kind, (bucket, text) in enumerate(grams(words, hashes)):
        own = weights[kind << BUCKET_BITS : (kind + 1) << BUCKET_BITS]
        total = np.bincount(text, own[bucket], texts)
        out += total / np.maximum(np.bincount(text, minlength=texts), 1)
    return out


def features(docs: DataFrame) -> DataFrame:
    """``label, at, share``: non-zero features of each labelled text, 4 bytes each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for first, last, words in blocks(batch.column(1)):
                found = grams(words, words.hashes())
                at, share = [], []
                for i in range(last - first):
                    places, values = [], []
                    for kind, (bucket, text) in enumerate(found):
                        a, b = np.searchsorted(text, [i, i + 1])
                        own, counts = np.unique(bucket[a:b], return_counts=True)
                        places.append(own + (kind << BUCKET_BITS))
                        values.append(counts / max(b - a, 1))
                    at.append(np.concatenate(places).astype("<i4").tobytes())
                    share.append(np.concatenate(values).astype("<f4").tobytes())
                yield {"doc_id": batch.column(0).slice(first, last - first), "label": batch.column(2).slice(first, last - first), "at": at, "share": share}

    return map_batches(docs, "doc_id long, label int, at binary, share binary", work)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(rows: list) -> np.ndarray | None:
    """Weights of all buckets and the constant, scaled so that the sigmoid of a sum is a probability."""
    rows = sorted(rows, key=lambda r: (r.doc_id, r.label, r.at))
    labels = np.array([r.label for r in rows], float)
    kept_back = np.arange(len(rows)) % CALIBRATION == 0
    if min(len(set(labels[kept_back])), len(set(labels[~kept_back]))) < 2:
        return None
    blocks_of_rows = [packed(rows[i : i + BLOCK_ROWS]) for i in range(0, len(rows), BLOCK_ROWS)]
    del rows
    size = KINDS << BUCKET_BITS

    def outputs(w: np.ndarray, constant: float) -> np.ndarray:
        return np.concatenate([np.bincount(row, share * w[at], n) for at, share, row, n in blocks_of_rows]) + constant

    def slopes(error: np.ndarray) -> np.ndarray:
        total, first = np.zeros(size), 0
        for at, share, row, n in blocks_of_rows:
            total += np.bincount(at, share * error[first : first + n][row], size)
            first += n
        return total

    # Shares as they are: a mark that fills a text weighs more than words that only one text has.
    learn = ~kept_back
    weight = np.where(labels == 1, 0.5 / labels[learn].mean(), 0.5 / (1 - labels[learn].mean())) * learn / learn.sum()
    step = 1 / (0.25 * (KINDS + 1) + RIDGE)  # a row's shares of one kind sum to 1
    w, constant, last, last_constant = np.zeros(size), 0.0, np.zeros(size), 0.0
    for turn in range(1, STEPS + 1):  # gradient descent with Nesterov's momentum
        ahead = (turn - 1) / (turn + 2)
        v, v_constant = w + ahead * (w - last), constant + ahead * (constant - last_constant)
        error = (sigmoid(outputs(v, v_constant)) - labels) * weight
        last, last_constant = w, constant
        w = v - step * (slopes(error) + RIDGE * v)
        constant = v_constant - step * error.sum()
    a, b = platt(outputs(w, constant)[kept_back], labels[kept_back])
    return np.append(a * w, a * constant + b)


def packed(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Buckets, shares and row numbers of some rows' features, and the number of rows."""
    at = np.concatenate([np.frombuffer(r.at, "<i4") for r in rows])
    share = np.concatenate([np.frombuffer(r.share, "<f4") for r in rows])
    return at, share, np.repeat(np.arange(len(rows), dtype=np.int32), [len(r.at) // 4 for r in rows]), len(rows)


def platt(z: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and constant of the logistic curve through (sum, label), with labels drawn in from 0 and 1."""
    positive = labels.sum()
    goal = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (len(labels) - positive + 2))
    x = np.stack([z, np.ones_like(z)], 1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ beta)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        beta = beta - np.clip(np.linalg.solve(hessian, x.T @ (p - goal)), -2, 2)
    return (float(beta[0]), float(beta[1])) if beta[0] > 0 else (1.0, 0.0)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> np.ndarray | None:
    """The classifier; features of at most ``rows`` texts reach the driver."""
    return fit(features(labelled_sample(docs, labels, rows)).collect())


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``probability`` and ``kept`` for every row of ``docs``."""
    return apply_rules(docs, train(docs, labels), typed(docs, {"doc_id": "long", "text": "string"}))


JUDGED = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, probability double, kept boolean"
)


def apply_rules(docs: DataFrame, weights: np.ndarray | None, plain: DataFrame) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast(weights)  # a fixed number of buckets

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for first, last, words in blocks(batch.column(1)):
                yield {"doc_id": batch.column(0).slice(first, last - first)} | judged(words, model.value)

    return map_batches(plain, "doc_id long, " + JUDGED, work)


def judged(words: Words, weights: np.ndarray | None) -> dict:
    hashes = words.hashes()
    counts = base_counts(words, hashes)
    n = counts["n_words"]
    failed = (n < LEAST_WORDS) | (100 * counts["n_repeat_words"] > 50 * n)
    if weights is None:
        probability, passes = pa.nulls(len(n), pa.float64()), np.ones(len(n), bool)
    else:
        probability = sigmoid(sums(words, hashes, weights))
        passes = probability >= KEEP_FROM
    del counts["n_lines"]
    return counts | {"base_failed": failed, "probability": probability, "kept": ~failed & passes}


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, words in blocks(batch.column(at).cast(pa.string())):
                yield batch.slice(first, last - first).filter(pa.array(judged(words, model.value)["kept"]))

    return docs.mapInArrow(run, docs.schema)
