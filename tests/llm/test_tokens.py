"""Token ids, counts, records and packing against the tokenizers library."""

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.fixtures import document_rows, frame
from zonecraft.llm import packing, records, token_counts
from zonecraft.llm.tokens import Encoder, encoder, tokenizer_path
from zonecraft.llm.words import blocks

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"
PIECES = ["a", "B", "foo", "bar.", "l'é", "it's", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", " ", "é", "́", "ß", "Σ", "İ", "中", "😀", "12", "***", "|", "<|endoftext|>", "<|startoftext|>", "'ll"]


@pytest.fixture(scope="module")
def libraries():
    return {n: Tokenizer.from_file(tokenizer_path(n)) for n in (BYTE, WORD)}


def expected(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", [BYTE, WORD])
@settings(max_examples=300, deadline=None)
@given(parts=st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), max_size=5))
def test_ids_of_blocks_are_those_of_the_library(libraries, name, parts):
    coder = encoder(tokenizer_path(name))
    for _, _, block in blocks(pa.array(parts, pa.string())):
        ids, bounds, _ = coder.encode_block(block)
        got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert got == [expected(libraries[name], p) for p in parts]


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr("zonecraft.llm.tokens.REMEMBERED", 10)
    coder = Encoder(tokenizer_path(WORD))
    coder.ids(" ".join(f"word{i}" for i in range(100)))
    assert len(coder.chunks) <= 10 and len(coder.chunks.old) <= 10
    assert coder.ids("word1 word99") == encoder(tokenizer_path(WORD)).ids("word1 word99")


@settings(max_examples=100, deadline=None)
@given(text=st.lists(st.sampled_from(PIECES), max_size=20).map("".join), data=st.data())
def test_every_prefix_has_its_exact_count(libraries, text, data):
    coder = encoder(tokenizer_path(WORD))
    table = token_counts.prefix_table(text, coder)
    cut = data.draw(st.integers(0, len(text)))
    ends, counts = table
    raw = text.encode()
    for end, count in zip(ends, counts, strict=True):
        assert count == len(expected(libraries[WORD], raw[:end].decode()))
    at_word = len(text[:cut].encode())
    if not any(token in text for token in ("<|endoftext|>", "<|startoftext|>")):
        assert token_counts.count_at(text, table, at_word, coder) == len(expected(libraries[WORD], text[:cut]))


def test_counts_and_budget(spark, libraries):
    rows = document_rows()
    got = {r.doc_id: r for r in token_counts.token_report(frame(spark, rows), WORD, limit=50).collect()}
    for doc_id, text, *_ in rows:
        ids = expected(libraries[WORD], text)
        r = got[doc_id]
        raw = (text or "").encode()
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(raw), len(ids), len(ids) > 50)
        assert len(expected(libraries[WORD], raw[: r.kept_bytes].decode())) == r.kept_tokens <= 50
    stored = token_counts.prefix_counts(frame(spark, rows), WORD).collect()
    assert {r.doc_id: (r.counts or [0])[-1] for r in stored} == {d: r.n_tokens for d, r in got.items()}


def test_records_hold_every_id_in_order(spark, libraries, tmp_path):
    rows = document_rows()
    shards = records.write_records(frame(spark, rows, 5), f"file://{tmp_path}/out", WORD)
    got = {r.doc_id: r for r in records.read_records(spark, shards).collect()}
    start = 0
    for doc_id, text, *_ in sorted(rows):
        ids = expected(libraries[WORD], text) + [1]
        assert (got[doc_id].start, got[doc_id].n_tokens) == (start, len(ids))
        assert got[doc_id].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert not list(tmp_path.glob("out/*tmp"))
    shuffled = [d for s in shards.collect() for d, _ in records.read_shuffled(s.path, 7)]
    assert sorted(shuffled) == sorted(got) and shuffled != sorted(got)


def test_records_with_null_and_repeated_ids(spark):
    rows = [(None, "a b", *["x"] * 2, 0, *"rkkpn"), (5, "b", *["x"] * 2, 0, *"rkkpn"), (5, "a", *["x"] * 2, 0, *"rkkpn")]
    rows = [(a, b, c, d, e, f, 0, h, i, j) for a, b, c, d, e, f, _, h, i, j in rows]
    got = records.record_report(frame(spark, rows), WORD).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 5, 5] and [r.start for r in got] == [0, 3, 5]


def test_changed_records_are_noticed():
    framed = records.frame(records.serialize(3, b"\x01\x00", 2))
    import io

    assert records.parse(records.read_frame(io.BytesIO(framed)))[0] == 3
    for place in (0, 9, 14, len(framed) - 1):
        broken = bytearray(framed)
        broken[place] ^= 1
        with pytest.raises((ValueError, MemoryError, OverflowError)):
            records.read_frame(io.BytesIO(bytes(broken)))
    with pytest.raises(ValueError):
        records.read_frame(io.BytesIO(framed[:-1]))
    assert struct.unpack("<Q", framed[:8])[0] == len(framed) - 16


def test_pieces_cover_every_id_once(spark, libraries):
    rows = document_rows()
    rows.append(rows[0])  # a repeated row has its own place
    got = packing.pack(frame(spark, rows, 4), BYTE, length=256).collect()
    by_sequence, by_document = {}, {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_document.setdefault(r.doc_id, []).append(r)
    for sequence, pieces in by_sequence.items():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 256 or sequence == max(by_sequence)
    for doc_id, text, *_ in rows:
        ids = np.array(expected(libraries[BYTE], text) + [1], "<u4")
        pieces = by_document[doc_id]
        times = 2 if doc_id == rows[0][0] else 1
        assert sum(p.length for p in pieces) == times * len(ids)
        for p in pieces:
            assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())


def test_neighbours_on_the_curve_are_neighbours_in_space():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = packing.hilbert_keys(grid, bits=3)
    assert sorted(keys) == list(range(512))
    walk = grid[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert packing.pack(empty, BYTE).count() == 0
    assert records.record_report(empty, WORD).count() == 0
    assert token_counts.token_report(empty, WORD).count() == 0


def test_a_file_without_lower_casing_is_encoded_whole(tmp_path):
    """A file of the same shape as the word-level one, but one that keeps capitals."""
    settings = json.loads(open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8").read())
    settings["normalizer"] = None
    path = tmp_path / "cased.json"
    path.write_text(json.dumps(settings), encoding="utf-8")
    cased = Encoder(str(path))
    text = "Hello WORLD abc, naïve Čx"
    ids = np.frombuffer(cased.ids(text), cased.kind).tolist()
    assert ids == cased.tokenizer.encode(text, add_special_tokens=False).ids
