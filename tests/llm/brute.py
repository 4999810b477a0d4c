"""Plain versions of the operators, for small inputs."""

import collections
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=5):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


def groups(rows, percent=75):
    """(id, text) rows to a list of (id, number of shingles, smallest linked id)."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    smallest = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            smallest[root(i)] = min(name, smallest.get(root(i), name))
    return [
        (name, len(s), smallest.get(root(i)) if s else name)
        for i, ((name, _), s) in enumerate(zip(rows, sets))
    ]


def contained(text, items, percent=75):
    """Ids of the (id, text) items that ``text`` contains."""
    found = set()
    for name, item in items:
        words = WORD.findall((item or "").translate(LOWER))
        want = shingles(item)
        have = shingles_of_length(text, min(5, len(words))) if words else set()
        if name is not None and want and 100 * len(want & have) >= percent * len(want):
            found.add(name)
    return sorted(found)


def shingles_of_length(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def repeated_bytes(texts, size):
    """For each text the flags of its removed bytes."""
    blobs = [(t or "").encode() for t in texts]
    starts = collections.Counter(
        b[i:i + size] for b in blobs for i in range(len(b) - size + 1))
    out = []
    for b in blobs:
        flags = [False] * len(b)
        for i in range(len(b) - size + 1):
            if starts[b[i:i + size]] > 1:
                flags[i:i + size] = [True] * size
        out.append(flags)
    return out


def runs(flags):
    return [
        (m.start(), m.end()) for m in re.finditer("1+", "".join("01"[f] for f in flags))
    ]
