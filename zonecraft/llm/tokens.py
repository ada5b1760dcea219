"""Exact token ids of whole texts from a public tokenizer file, with the work done once per distinct piece.

A text is cut only at places where the tokenizer itself always cuts, so the ids of the pieces joined are the ids of the
text. Which places these are follows from the file: a pre-tokenizer that drops white space allows every ASCII white
space; the byte-level one, which keeps it, allows the place before a single space or newline between visible
characters. Any other file, and texts with other white space, are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Callable
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa

from zonecraft.llm.words import Words, split

# Bytes of text whose distinct words are looked up together.
ENCODED = 3 << 19
# Pieces remembered per worker process, twice: when the newer half is full it becomes the older one.
REMEMBERED = 300_000
# First bytes of characters that are visible in every version of Unicode: printable ASCII and the Latin letters.
VISIBLE = np.zeros(256, bool)
VISIBLE[[*range(33, 127), *range(0xC3, 0xC9)]] = True
# Bytes of letters of ASCII, the first byte of those of Latin-1, and bytes of marks other than the apostrophe; words with
# "<", which may be special strings, are left to the tokenizer.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123), 0xC3]] = True
MARKS = np.zeros(256, bool)
MARKS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in "'<"]] = True
# Letters of ASCII and Latin-1, then ASCII marks other than the apostrophe: two pieces under both pre-tokenizers.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
# The letters alone, as bytes.
_LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer file; a path is taken as it is."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The visible character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    letters |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in letters)}
    return [letters[b] for b in range(256)]


class Memory(dict):
    """Results by piece; the newer and the older half are bounded by ``REMEMBERED`` each."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, piece):
        value = self.old.get(piece) if self.old else None
        if value is None:
            value = self.make(piece)
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[piece] = value
        return value


class Encoder:
    """``ids(text)`` gives the ids as little-endian unsigned integers of ``width`` bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.dtype("<u2" if self.width == 2 else "<u4")
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        model = settings["model"]
        added = [t["content"] for t in settings["added_tokens"]]
        pre = json.dumps(settings["pre_tokenizer"])
        # Pieces can be given straight to the model where it has no settings that act across them.
        direct = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "ignore_merges", "byte_fallback"))
        direct = direct and not any(_PLAIN.fullmatch(a) or " " in a or "\n" in a for a in added)
        cut = [settings["normalizer"], pre, settings["post_processor"], any(t["lstrip"] or t["rstrip"] for t in settings["added_tokens"])]
        self.mode = "whole"
        if direct and not cut[3]:
            if settings["normalizer"] is None and '"ByteLevel", "add_prefix_space": false' in pre and '"use_regex": true' in pre:
                self.mode = "space"
            elif '"behavior": "Removed", "invert": true' in pre and "[^\\\\s\\\\p{L}\\\\p{N}]+" in pre:
                # Words are put in lower case here, so the file must do that too.
                self.mode = "word" if '"Lowercase"' in json.dumps(settings["normalizer"]) else "whole"
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = byte_letters()
        self.code = "H" if self.width == 2 else "I"
        self.chunks = Memory(self._word if self.mode == "word" else self._spaced)
        self.bare = Memory(self._piece)
        self.others = Memory(self._whole)

    def _pack(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _whole(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: bytes) -> bytes:
        """A piece in which no further cut is possible."""
        letters = self.letters
        return self._pack([t.id for t in self.tokenize("".join([letters[b] for b in piece]))])

    def _word(self, word: bytes) -> bytes:
        if word.isalpha() and word.islower():  # ASCII letters only
            return self._pack([t.id for t in self.tokenize(word.decode())])
        text = word.decode()
        plain = _PLAIN.fullmatch(text)
        if not plain or b"<|" in word:
            return self._whole(text)
        if plain[2]:
            return self.chunks[plain[1].encode()] + self.bare[plain[2].encode()]
        return self._piece(text.lower().encode())

    def _spaced(self, chunk: bytes) -> bytes:
        """A word with the space or newline before it."""
        word = chunk[1:]
        if chunk[0] == 32 and word.isalpha():  # ASCII letters only
            return self._pack([t.id for t in self.tokenize(self.letters[32] + word.decode())])
        if not _LETTERS.fullmatch(word):
            return self._whole(chunk.decode())
        return self.bare[b"\n"] + self.bare[word] if chunk[0] == 10 else self._piece(chunk)

    def ids(self, text: str) -> bytes:
        """The ids of one text, packed."""
        flat, _, _ = self.encode_block(single(text.encode()))
        return flat.tobytes()

    def encode_block(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts of a block, where each text's ids begin (one more than texts), and ids per word.

        Ids per word are only complete in mode "word". Each distinct word of the block is looked up once.
        """
        raw = words.data.tobytes()
        n = len(words.counts)
        if self.mode == "whole":
            return self._join([self._whole(raw[a:b].decode()) for a, b in pairwise(words.offsets.tolist())])
        lead, odd = leads(words) if self.mode == "space" else (None, np.zeros(n, bool))
        pieces, of_word, bare = split_marks(words, None if lead is None else lead == 0)
        keys = pieces.hashes()
        if lead is not None:
            lead = np.where(bare, np.uint64(3), lead[of_word])
            keys = keys + lead * np.uint64(0x9E3779B97F4A7C15)
        at, inverse = distinct(keys)
        starts, ends = pieces.starts[at], pieces.ends[at]
        if self.mode == "word":
            found = [self.chunks[raw[a:b]] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        else:
            found = self._by_kind(raw, words.data, starts, ends, lead[at])
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.width
        flat = np.frombuffer(b"".join(found), self.kind)
        each = sizes[inverse]
        before = np.concatenate([[0], np.cumsum(each)])
        begins = (np.cumsum(sizes) - sizes)[inverse]
        ids = flat[np.repeat(begins - before[:-1], each) + np.arange(before[-1])]
        # The pieces of a word follow each other, so a text's ids begin with those of its first word's first piece.
        first = np.searchsorted(of_word, np.arange(len(words.starts) + 1))
        bounds = before[first[words.bounds]]
        each = np.diff(before[first])
        if odd.any():
            parts = [
                self._whole(raw[words.offsets[i] : words.offsets[i + 1]].decode()) if odd[i] else ids[bounds[i] : bounds[i + 1]].tobytes()
                for i in range(n)
            ]
            return self._join(parts)
        return ids, bounds, each

    def _by_kind(self, raw: bytes, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: np.ndarray) -> list[bytes]:
        """Ids of pieces: first words of texts, words with the byte before them (a space or newline), marks."""
        found = np.empty(len(ends), object)
        after = starts - 1
        after[(kind == 0) | (kind == 3)] += 1
        # Words after other gaps stand in texts that are encoded whole; their key is that of a word after a space.
        strange = (kind == 1) & (data[after] != 32)
        for which, known in enumerate((self.others, self.chunks, self.chunks, self.bare)):
            at = np.flatnonzero((kind == which) & ~strange)
            spans = zip(after[at].tolist(), ends[at].tolist(), strict=True)
            ids = [known[raw[a:b].decode()] for a, b in spans] if which == 0 else [known[raw[a:b]] for a, b in spans]
            found[at] = np.fromiter(ids, object, len(ids))
        for i in np.flatnonzero(strange).tolist():
            found[i] = self.chunks[b" " + raw[starts[i] : ends[i]]]
        return found.tolist()

    def _join(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // self.width
        return np.frombuffer(b"".join(parts), self.kind), np.concatenate([[0], np.cumsum(sizes)]), sizes


def single(raw: bytes) -> Words:
    return split(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct key first stands, and which of these every key is; by a hash table, which is faster than sorting."""
    found = pa.array(keys).dictionary_encode()
    which = found.indices.to_numpy()
    at = np.empty(len(found.dictionary), np.int64)
    at[which[::-1]] = np.arange(len(keys) - 1, -1, -1)
    return at, which


def split_marks(words: Words, whole: np.ndarray | None) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words as pieces: letters followed by marks are two pieces, as in ``_PLAIN``, any other word is one.

    Returns the pieces, the word each belongs to, and which are marks. Words that ``whole`` names stay whole.
    """
    data, starts, ends = words.data, words.starts, words.ends
    letters = LETTERS[data]
    first = np.flatnonzero(data[:-1] == 0xC3)
    second = data[first + 1]
    letters[first + 1] = (second >= 0x80) & (second <= 0xBF) & (second != 0x97) & (second != 0xB7)
    others = np.concatenate([np.zeros(1, np.int32), np.cumsum(~letters, dtype=np.int32)])
    cut = ends.copy()
    ending = np.flatnonzero(MARKS[data[ends - 1]])
    while len(ending):  # words that still end with a mark lose it
        cut[ending] -= 1
        ending = ending[cut[ending] > starts[ending]]
        ending = ending[MARKS[data[cut[ending] - 1]]]
    two = (cut < ends) & (cut > starts) & (others[cut] == others[starts])
    if whole is not None:
        two &= ~whole
    place = np.arange(len(starts)) + np.concatenate([[0], np.cumsum(two)])[:-1]
    size = len(starts) + int(two.sum())
    begins, finishes, bare = np.empty(size, np.int64), np.empty(size, np.int64), np.zeros(size, bool)
    begins[place], finishes[place] = starts, np.where(two, cut, ends)
    second = place[two] + 1
    begins[second], finishes[second], bare[second] = cut[two], ends[two], True
    of_word = np.repeat(np.arange(len(starts)), two + 1)
    return Words(data, begins, finishes, words.bounds, words.offsets), of_word, bare


def leads(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Per word: 0 at the start of a text, 1 after a space, 2 after a newline. Per text: whether it has other gaps."""
    counts, data = words.counts, words.data
    n = len(counts)
    odd = np.zeros(n, bool)
    lead = np.zeros(len(words.starts), np.uint64)
    text = np.repeat(np.arange(n), counts)
    has = counts > 0
    first, last = words.bounds[:-1][has], words.bounds[1:][has] - 1
    inner = np.ones(len(words.starts), bool)
    inner[first] = False
    at = np.flatnonzero(inner)
    gap = data[words.starts[at] - 1]
    lead[at] = np.where(gap == 10, 2, 1)
    wrong = (words.starts[at] - words.ends[at - 1] != 1) | ((gap != 32) & (gap != 10)) | ~VISIBLE[data[words.starts[at]]]
    odd[text[at[wrong]]] = True
    own = np.flatnonzero(has)
    odd[own] |= (words.starts[first] != words.offsets[:-1][own]) | (words.ends[last] != words.offsets[1:][own])
    odd |= ~has & (np.diff(words.offsets) > 0)
    return lead, odd


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)
