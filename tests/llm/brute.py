"""Plain Python statements of what the operators must return, for small inputs."""

import re
from itertools import combinations

SPACE = re.compile("[^\x20\x09-\x0d]+")


def removed_bytes(rows, width=100):
    """rows: (doc_id, text); per row the flags of removed bytes."""
    seen, out = set(), {}
    for i, text in sorted((i, (t or "").encode()) for i, t in rows):
        gone = [False] * len(text)
        for at in range(len(text) - width + 1):
            piece = text[at : at + width]
            if piece in seen:
                gone[at : at + width] = [True] * width
            seen.add(piece)
        out[i] = gone
    return out


def removed_words(rows, width=50):
    first, out = {}, {}
    texts = {i: SPACE.findall(t or "") for i, t in rows}
    for i, words in texts.items():
        for at in range(len(words) - width + 1):
            piece = tuple(words[at : at + width])
            first[piece] = min(i, first.get(piece, i))
    for i, words in texts.items():
        gone = [False] * len(words)
        for at in range(len(words) - width + 1):
            if first[tuple(words[at : at + width])] < i:
                gone[at : at + width] = [True] * width
        out[i] = (words, gone)
    return out


def shingles(text, n=3):
    words = SPACE.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}


def components(rows, percent=90, n=3):
    """doc_id: smallest doc_id reachable."""
    sets = {i: shingles(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}, {i: len(s) for i, s in sets.items()}
