"""Plain versions that the operators are held against."""

import hashlib
import re
from collections import defaultdict


class Sets:
    """Union-find that names a set by its smallest member."""

    def __init__(self, names):
        self.up = {n: n for n in names}

    def find(self, n):
        while self.up[n] != n:
            n = self.up[n]
        return n

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0d]+", text) if w]


def shingles(text, width):
    w = words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def jaccard(docs, width, percent):
    """{id: (set size, smallest id reached)} of {id: text}."""
    sets = {d: shingles(t, width) for d, t in docs.items()}
    found, holders = Sets(docs), defaultdict(list)
    for d, s in sets.items():
        shared = defaultdict(int)
        for x in s:
            for other in holders[x]:
                shared[other] += 1
            holders[x].append(d)
        for other, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[other]) - n):
                found.join(d, other)
    return {d: (len(sets[d]), found.find(d)) for d in docs}


def covered(docs, width):
    """{id: list of booleans per byte} of {id: bytes}: bytes in strings that smaller ids hold."""
    least = {}
    for d, t in docs.items():
        for i in range(len(t) - width + 1):
            s = t[i : i + width]
            least[s] = min(least.get(s, d), d)
    result = {}
    for d, t in docs.items():
        marks = [False] * len(t)
        for i in range(len(t) - width + 1):
            if least[t[i : i + width]] < d:
                marks[i : i + width] = [True] * width
        result[d] = marks
    return result


def cut(text, marks):
    """(bytes, removed, spans, digest of the rest)."""
    spans = sum(m and not (i and marks[i - 1]) for i, m in enumerate(marks))
    rest = bytes(b for b, m in zip(text, marks) if not m)
    return len(text), sum(marks), spans, hashlib.sha256(rest).hexdigest()
