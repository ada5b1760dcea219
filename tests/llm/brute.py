"""Plain versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def split(text):
    return WORD.findall(text or "")


def shingles(text, width=5):
    w = [x.translate(LOWER) for x in split(text)]
    return {tuple(w[j : j + width]) for j in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def components(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            having[g].append(i)
    for a, b in {(a, b) for ids in having.values() for a in ids for b in ids if a < b}:
        common = len(sets[a] & sets[b])
        if 100 * common >= 80 * len(sets[a] | sets[b]):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def without_repeats(rows, window=13):
    first, found = {}, {}
    for i, text in sorted(rows):
        w = split(text)
        for j in range(len(w) - window + 1):
            first.setdefault(tuple(w[j : j + window]), i)
    for i, text in rows:
        w = split(text)
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if first[tuple(w[j : j + window])] < i:
                gone[j : j + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        found[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return found


def base_rules(text):
    w, text = split(text), text or ""
    seen, lines = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    counts = Counter(zip(w, w[1:], w[2:], strict=False))
    hit = [False] * len(w)
    for j in range(len(w) - 2):
        if counts[tuple(w[j : j + 3])] > 1:
            hit[j : j + 3] = [True] * 3
    n, again = len(w), sum(hit)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), lines, again, n < 50 or 100 * again > 50 * n


ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)
