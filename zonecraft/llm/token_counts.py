"""Token counts by prefix dynamic programming.

For a text cut into pieces p1..pk the table holds C[j] = C[j-1] + tokens(pj) and the byte at which piece j ends. Pieces are
cut only where the tokenizer always cuts, so C[j] is the exact count of the prefix that ends there; a prefix that ends
inside a piece adds the count of that part of one piece. Truncation and budget questions are searches in C.

NULL and empty texts have no pieces and count 0. A text with no safe cut is one piece. Rows are independent: ties,
repeated rows, NULL ids and other columns (which are not read) change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from zonecraft.llm.common import map_batches, typed
from zonecraft.llm.tokens import ENCODED, Encoder, encoder, single, tokenizer_path
from zonecraft.llm.words import Words, blocks

LIMIT = 2048


def block_counts(words: Words, coder: Encoder) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the texts of a block: running count at the end of each piece, piece ends, and where texts begin in both."""
    _, bounds, each = coder.encode_block(words)
    if coder.mode == "word":
        ends, starts = words.ends, words.bounds
    else:  # a text is one piece, an empty one none
        each = np.diff(bounds)
        filled = np.diff(words.offsets) > 0
        each, ends = each[filled], words.offsets[1:][filled]
        starts = np.concatenate([[0], np.cumsum(filled)])
    counts = np.cumsum(each)
    before = np.concatenate([[0], counts])[starts[:-1]]
    sizes = np.diff(starts)
    return counts - np.repeat(before, sizes), ends - np.repeat(words.offsets[:-1], sizes), starts


def prefix_table(text: str, coder: Encoder) -> tuple[np.ndarray, np.ndarray]:
    """Bytes at which pieces end, and the exact token count of each such prefix."""
    counts, ends, _ = block_counts(single(text.encode()), coder)
    return ends, counts


def count_at(text: str, table: tuple[np.ndarray, np.ndarray], n_bytes: int, coder: Encoder) -> int:
    """Tokens of the first ``n_bytes`` bytes (a character boundary): a search, and at most one part of a piece."""
    ends, counts = table
    whole = int(np.searchsorted(ends, n_bytes, "right"))
    before = int(counts[whole - 1]) if whole else 0
    part = text.encode()[int(ends[whole - 1]) if whole else 0 : n_bytes].decode()
    return before + len(coder.ids(part)) // coder.width


def longest_within(table: tuple[np.ndarray, np.ndarray], budget: int) -> tuple[int, int]:
    """Bytes and tokens of the longest run of whole pieces from the start that has at most ``budget`` tokens."""
    ends, counts = table
    whole = int(np.searchsorted(counts, budget, "right"))
    return (int(ends[whole - 1]), int(counts[whole - 1])) if whole else (0, 0)


def prefix_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id``, ``ends`` and ``counts``: the stored table of every text, for later questions without re-encoding."""
    path = tokenizer_path(tokenizer)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        coder = encoder(path)
        for batch in batches:
            for first, last, words in blocks(batch.column(1), ENCODED):
                counts, ends, starts = block_counts(words, coder)
                cut = lambda values, at=starts: [values[a:b] for a, b in pairwise(at.tolist())]
                yield {"doc_id": batch.column(0).slice(first, last - first), "ends": cut(ends), "counts": cut(counts)}

    return map_batches(typed(docs, {"doc_id": "long", "text": "string"}), "doc_id long, ends array<long>, counts array<long>", work)


def token_report(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """Per document: bytes, tokens, whether they exceed ``limit``, and the longest prefix within it."""
    path = tokenizer_path(tokenizer)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        coder = encoder(path)
        for batch in batches:
            for first, last, words in blocks(batch.column(1), ENCODED):
                counts, ends, starts = block_counts(words, coder)
                sizes = np.diff(words.offsets)
                totals, kept, kept_tokens = [], [], []
                for size, a, b in zip(sizes.tolist(), starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                    total = int(counts[b - 1]) if b > a else 0
                    within = (size, total) if total <= limit else longest_within((ends[a:b], counts[a:b]), limit)
                    totals.append(total)
                    kept.append(within[0])
                    kept_tokens.append(within[1])
                yield {
                    "doc_id": batch.column(0).slice(first, last - first),
                    "n_bytes": sizes,
                    "n_tokens": totals,
                    "over_limit": [t > limit for t in totals],
                    "kept_bytes": kept,
                    "kept_tokens": kept_tokens,
                }

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, kept_bytes long, kept_tokens long"
    return map_batches(typed(docs, {"doc_id": "long", "text": "string"}), schema, work)
