"""A frequency-ordered trie of restricted term vectors with a branch-and-bound search; travels with the tasks, see `lexical`."""

from __future__ import annotations

import numpy as np

LEAF = 16


class Best:
    """The k highest (score, smaller id) so far."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.least, self.last = 1, None  # what a row must reach, and below which id if it only equals it

    def may_enter(self, bound: int, first_id: int) -> bool:
        return bound > self.least or bound == self.least and (self.last is None or first_id < self.last)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.least
        if not good.any():
            return
        scores, ids = np.concatenate([self.scores, scores[good]]), np.concatenate([self.ids, ids[good]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.least, self.last = int(self.scores[-1]), int(self.ids[-1])


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


class Trie:
    """Documents of one block, ordered by their terms from the most frequent on, so that equal beginnings share a path.

    A node is a range of that order. It keeps for each term the largest tf and the smallest m below it, and from them
    the most that the term can add to a score there. Ranges of at most `LEAF` documents, or of equal vectors, are
    leaves; small neighbours under one path share a leaf.
    """

    def __init__(self, ids: np.ndarray, m: np.ndarray, sizes: np.ndarray, ranks: np.ndarray, tf: np.ndarray, weight: np.ndarray):
        """Terms of each document in ascending `ranks`; `weight` by rank."""
        ends = np.cumsum(sizes)
        starts = ends - sizes
        wide = ranks.astype(">u4").tobytes()
        order = sorted(range(len(ids)), key=lambda i: wide[4 * starts[i] : 4 * ends[i]])
        order = np.array(order, np.int64)
        self.ids, self.m, sizes = ids[order], m[order], sizes[order]
        self.ptr = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(starts[order] - self.ptr[:-1], sizes) + np.arange(self.ptr[-1])
        self.terms, tf = ranks[at], tf[at]
        of = np.repeat(np.arange(len(ids)), sizes)
        self.adds = weight[self.terms] * gain(tf, self.m[of])
        self.split()
        nodes = len(self.low)
        most, least = np.zeros((nodes, len(weight)), np.int64), np.zeros(nodes, np.int64)
        leaf_of = np.repeat(self.leaves, self.high[self.leaves] - self.low[self.leaves])
        np.maximum.at(most, (leaf_of[of], self.terms), tf)
        least[self.leaves] = np.minimum.reduceat(self.m, self.low[self.leaves])
        self.first = np.zeros(nodes, np.int64)
        self.first[self.leaves] = np.minimum.reduceat(self.ids, self.low[self.leaves])
        for node in range(nodes - 1, -1, -1):  # children come after their parent
            below = self.children[node]
            if below:
                most[node] = most[below].max(0)
                least[node], self.first[node] = least[below].min(), self.first[below].min()
        self.most = weight * gain(most, least[:, None])

    def split(self) -> None:
        low, high, children, leaves = [0], [len(self.ids)], [[]], []
        todo = [0]
        while todo:
            node = todo.pop()
            a, b = low[node], high[node]
            depth = 0 if b - a <= LEAF else self.shared(a, b - 1)
            if b - a <= LEAF or depth is None:
                leaves.append(node)
                continue
            at = self.ptr[a:b] + depth
            step = np.where(at < self.ptr[a + 1 : b + 1], self.terms[np.minimum(at, len(self.terms) - 1)], -1)
            edges = [a, *(a + 1 + np.flatnonzero(np.diff(step))).tolist(), b]
            begin = a
            for k in range(1, len(edges)):
                # a run of small children ends where the next one would make it too large
                if k == len(edges) - 1 or edges[k + 1] - begin > LEAF:
                    children[node].append(len(low))
                    todo.append(len(low))
                    low.append(begin)
                    high.append(edges[k])
                    children.append([])
                    begin = edges[k]
        leaves.sort(key=low.__getitem__)
        self.low, self.high, self.children, self.leaves = np.array(low), np.array(high), children, np.array(leaves)

    def shared(self, a: int, b: int) -> int | None:
        """How many first terms documents a to b share; None if their vectors are equal."""
        x, y = (self.terms[self.ptr[i] : self.ptr[i + 1]] for i in (a, b))
        n = min(len(x), len(y))
        differ = np.flatnonzero(x[:n] != y[:n])
        if len(differ):
            return int(differ[0])
        return None if len(x) == len(y) else n

    def search(self, ranks: np.ndarray, best: Best) -> int:
        """Offer what an item of these terms may find here, the most promising child first; the number of documents scored."""
        bound = self.most[:, ranks].sum(1).tolist()
        wanted = np.zeros(self.most.shape[1], bool)
        wanted[ranks] = True
        todo, scored = [0], 0
        while todo:
            node = todo.pop()
            if not best.may_enter(bound[node], self.first[node]):
                continue
            below = self.children[node]
            if below:
                todo += sorted(below, key=bound.__getitem__)
                continue
            a, b = self.low[node], self.high[node]
            ptr = self.ptr[a : b + 1]
            upto = np.concatenate([[0], np.cumsum(np.where(wanted[self.terms[ptr[0] : ptr[-1]]], self.adds[ptr[0] : ptr[-1]], 0))])
            ends = upto[ptr - ptr[0]]
            best.offer(ends[1:] - ends[:-1], self.ids[a:b])
            scored += b - a
        return scored
