"""Packing along a space-filling curve.

A document's token ids are counted into a hashed vector, which a fixed random matrix projects to few dimensions. The
place on a Hilbert curve through the projections orders the documents, so neighbours on the curve have similar texts.
Token ids are laid end to end in that order and cut every ``SEQUENCE`` ids: no sequence but the last has padding.

NULL and empty texts are the end id alone. Rows of equal texts tie on the curve and follow by document id (NULL first),
repeated rows each have their own place. An empty table gives no pieces. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from zonecraft.llm.common import Stages, map_batches, typed
from zonecraft.llm.tokens import ENCODED, encoder, tokenizer_path
from zonecraft.llm.words import blocks
from zonecraft.operators.running import running_total

SEQUENCE = 2048
END_ID = 1
BUCKET_BITS = 10
DIMENSIONS = 4
BITS = 15
COUNTED = 256
SEED = 20_011

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def directions() -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((1 << BUCKET_BITS, DIMENSIONS))


def project(flat: np.ndarray, bounds: np.ndarray, end_id: int, matrix: np.ndarray) -> np.ndarray:
    """Coordinates 0 .. 2**BITS - 1 of each document of a block: damped hashed counts of unit length, projected and squashed.

    ``flat`` holds the ids of all documents, which begin at ``bounds``; each has the end id besides.
    """
    n, width = len(bounds) - 1, 1 << BUCKET_BITS
    bucket = lambda ids: ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    sizes = np.diff(bounds)
    out = np.empty((n, matrix.shape[1]))
    for a in range(0, n, COUNTED):  # one dense table of counts for some hundred documents
        b = min(a + COUNTED, n)
        of = np.repeat(np.arange(b - a), sizes[a:b])
        counts = np.bincount(of * width + bucket(flat[bounds[a] : bounds[b]]), minlength=(b - a) * width).reshape(b - a, width)
        counts[:, bucket(np.array([end_id]))[0]] += 1
        out[a:b] = np.sqrt(counts) @ matrix / np.sqrt(sizes[a:b] + 1)[:, None]
    unit = 1 / (1 + np.exp(-1.702 * out))
    return np.minimum((unit * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index along the Hilbert curve of points with ``bits`` bits per coordinate (coordinates are columns)."""
    axes = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    n = len(axes)
    # Undo the curve's reflections and rotations, from the coarsest cell to the finest.
    cell = 1 << (bits - 1)
    while cell > 1:
        low = cell - 1
        for i in range(n):
            upper = (axes[i] & cell) != 0
            swap = np.where(upper, 0, (axes[0] ^ axes[i]) & low)
            axes[0] = np.where(upper, axes[0] ^ low, axes[0] ^ swap)
            if i:
                axes[i] = axes[i] ^ swap
        cell >>= 1
    for i in range(1, n):
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros_like(axes[0])
    cell = 1 << (bits - 1)
    while cell > 1:
        turn = np.where((axes[-1] & cell) != 0, turn ^ (cell - 1), turn)
        cell >>= 1
    axes = [a ^ turn for a in axes]
    key = np.zeros_like(axes[0])
    for bit in range(bits - 1, -1, -1):
        for a in axes:
            key = key << 1 | (a >> bit & 1)
    return key


def curve_places(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Per row: a row number, document id, Hilbert key, number of ids, and the ids in binary with their width."""
    path = tokenizer_path(tokenizer)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        coder, matrix = encoder(path), directions()
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, last, words in blocks(batch.column(1), ENCODED):
                flat, bounds, _ = coder.encode_block(words)
                n = len(bounds) - 1
                # All ids of the block in one buffer, each document's followed by the end id.
                whole = np.insert(flat, bounds[1:], end_id)
                ends = (bounds + np.arange(n + 1)) * coder.width
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(whole)])
                yield {
                    "row": np.arange(row, row + n),
                    "doc_id": batch.column(0).slice(first, last - first),
                    "key": hilbert_keys(project(flat, bounds, end_id, matrix)),
                    "n": np.diff(bounds) + 1,
                    "width": [coder.width] * n,
                    "ids": packed,
                }
                row += n

    plain = typed(docs, {"doc_id": "long", "text": "string"})
    return map_batches(plain, "row long, doc_id long, key long, n long, width int, ids binary", work)


def pack(docs: DataFrame, tokenizer: str, length: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: which ids of which document lie where in which sequence."""
    stages = Stages(docs.sparkSession, "packing")
    encoded = stages.write(curve_places(docs, tokenizer, end_id), "ids")
    slim = encoded.select("row", "doc_id", "key", "n")
    placed = running_total(slim, [], ["key", "doc_id", "row"], "n", "place").select("row", "place")
    joined = encoded.select("row", "doc_id", "width", "ids").join(placed, "row").drop("row")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encoder.cache_clear()  # a worker that has encoded before needs its memory for the join
        for batch in batches:
            pieces: list[tuple] = []
            for doc_id, width, ids, place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pieces += cut(doc_id, np.frombuffer(ids, f"<u{width}"), place, length)
            yield dict(zip(PIECE_NAMES, zip(*pieces, strict=True), strict=True)) if pieces else {n: [] for n in PIECE_NAMES}

    return map_batches(joined, PIECES, work)


PIECE_NAMES = [c.split()[0] for c in PIECES.split(", ")]


def cut(doc_id: int | None, ids: np.ndarray, place: int, length: int) -> list[tuple]:
    """The pieces of a document whose first id is number ``place`` of the whole stream."""
    full = ids.astype("<u4")
    pieces, start = [], 0
    while start < len(full):
        offset = (place + start) % length
        size = min(length - offset, len(full) - start)
        crc = zlib.crc32(full[start : start + size].tobytes())
        pieces.append((doc_id, start, size, crc, len(full), (place + start) // length, offset))
        start += size
    return pieces
