"""Small tables for the operators' tests, with every awkward kind of row."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, kind int, key string, place string, node string"


def words(rng: random.Random, count: int, pool: int = 400) -> str:
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(count))


def edited(rng: random.Random, text: str, edits: int) -> str:
    parts = text.split(" ")
    for _ in range(edits):
        parts[rng.randrange(len(parts))] = f"e{rng.randrange(10**6)}"
    return " ".join(parts)


def document_rows(seed: int = 1) -> list[tuple]:
    """Copies, near copies, shared passages, short, empty, NULL and very long texts, NULL sources; ids are unique."""
    rng = random.Random(seed)
    base = words(rng, 120)
    passage = words(rng, 40)
    texts: list[str | None] = [base, base, base.upper(), None, "", "  \n\t ", "one two three", "One two  three", "x"]
    texts += [edited(rng, base, k) for k in (1, 1, 2, 3, 4, 5, 6, 9, 14)]
    texts += [f"{words(rng, 60)} {passage}\n{words(rng, 30)}" for _ in range(6)]
    texts += [passage, passage + " tail", words(rng, 30_000, 5000), "longword" * 5000, "rep " * 200]
    texts += [words(rng, rng.randrange(1, 200)) for _ in range(25)]
    texts += ["naïve café 中文 text here   line", "<|endoftext|> it's a <|startoftext|>\x1ctest", "a\n\na\nb\n a\n"]
    rng.shuffle(texts)
    rows = []
    for i, text in enumerate(texts):
        source = None if i % 11 == 0 else f"src{i % 4}"
        rows.append((3 * i + 1, text, "en", source, len(text or ""), "r", 0, "k", "p", "n"))
    return rows


def frame(spark, rows, partitions: int = 3):
    return spark.createDataFrame(rows, DOCS).repartition(partitions)
