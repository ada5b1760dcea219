"""Counts per text over blocks of an Arrow column, shared by the quality operators."""

from __future__ import annotations

import numpy as np

from zonecraft.llm.words import WHITE, Words, windows

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
CONTINUES = np.zeros(256, bool)  # bytes after the first one of a character
CONTINUES[0x80:0xC0] = True


def per_text(flags: np.ndarray, words: Words) -> np.ndarray:
    """Bytes of each text for which ``flags`` holds."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[words.offsets[1:]] - total[words.offsets[:-1]]


def repeated_words(hashes: np.ndarray, bounds: np.ndarray, width: int = 3) -> np.ndarray:
    """Words of each text that lie in a window of ``width`` words found at least twice in it."""
    long, _ = windows(hashes, bounds, width)
    counts = np.zeros(len(bounds) - 1, np.int64)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        n = b - a - width + 1
        if n < 2:
            continue
        own = long[a : a + n]
        order = np.argsort(own, kind="stable")
        same = own[order[1:]] == own[order[:-1]]
        if same.any():
            twice = np.zeros(n, bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            hit = np.zeros(b - a + 1, np.int64)
            at = np.flatnonzero(twice)
            hit[at] += 1
            np.subtract.at(hit, at + width, 1)
            counts[i] = int((np.cumsum(hit)[:-1] > 0).sum())
    return counts


def duplicate_lines(raw: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and lines with a word."""
    seen, again, count = set(), 0, 0
    for line in raw.split(b"\n"):
        if line.strip(b" \t\n\r\x0b\x0c"):
            count += 1
            if line in seen:
                again += 1
            seen.add(line)
    return again, count


def base_counts(words: Words, hashes: np.ndarray) -> dict[str, np.ndarray]:
    """``word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words, n_words`` of each text of a block."""
    data = words.data
    raw = data.tobytes()
    lines = [duplicate_lines(raw[a:b]) for a, b in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True)]
    lines = np.array(lines, np.int64).reshape(-1, 2)
    return {
        "n_words": words.counts,
        "word_chars": per_text(~WHITE[data] & ~CONTINUES[data], words),
        "n_symbols": per_text(SYMBOLS[data], words),
        "n_dup_lines": lines[:, 0],
        "n_lines": lines[:, 1],
        "n_repeat_words": repeated_words(hashes, words.bounds),
    }
