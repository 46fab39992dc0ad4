"""Boosted trees on binned features in numpy; travels with the tasks, see `boosting`.

A tree is kept as arrays over node numbers: the root is 1, the children of node i are 2i and 2i + 1, and a row goes left
where its bin is at most the node's cut. `feature` is -1 at leaves.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# as much of the best gain as a split may lack and still count as equally good: sums differ by rounding only
TIE = 1e-8
BLOCK_ROWS = 1 << 16  # rows that are summed at a time; their columns stay in a core's cache

ROUTED_ROWS = 1 << 13  # rows that go down a tree at a time


@dataclass(frozen=True)
class Settings:
    """`classes` 0 is least squares, else so many classes by softmax; `l2` is added to every hessian sum."""

    iters: int = 100
    depth: int = 5
    step: float = 0.1
    min_leaf: float = 1.0
    min_split: float = 2.0
    l2: float = 0.0
    classes: int = 0


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Features x rows: how many edges of its feature each value exceeds."""
    return np.stack([np.searchsorted(e, column, "left") for e, column in zip(edges, x.T)]).astype(np.uint8)


def slopes(y: np.ndarray, raw: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Negative gradients and hessians (outputs x rows) of the loss at the raw scores."""
    if not classes:
        return (y - raw[0])[None], np.ones((1, len(y)))
    p = chances(raw)
    return (y[None] == np.arange(classes)[:, None]) - p, p * (1 - p)


def chances(raw: np.ndarray) -> np.ndarray:
    e = np.exp(raw - raw.max(0))
    return e / e.sum(0)


def start(weights: np.ndarray, total: float, classes: int) -> np.ndarray:
    """Raw scores before the first tree: the mean (of `total` over `weights`), or the logs of the class shares."""
    if not classes:
        return np.array([total / weights.sum()])
    return np.log((weights + 1) / (weights.sum() + classes))


def histogram(bins: np.ndarray, slot: np.ndarray, g: np.ndarray, h: np.ndarray, slots: int, size: int) -> np.ndarray:
    """(slots, features, bins, 2): sums of h and g; rows of slot -1 are left out."""
    if (slot < 0).any():
        some = np.flatnonzero(slot >= 0)
        bins, slot, g, h = [column.take(some) for column in bins], slot.take(some), g.take(some), h.take(some)
    out = np.empty((slots, len(bins), size, 2))
    base, plain = slot * size, bool((h == 1).all())
    for f, column in enumerate(bins):
        at = base + column
        out[:, f, :, 0] = np.bincount(at, None if plain else h, slots * size).reshape(slots, size)
        out[:, f, :, 1] = np.bincount(at, g, slots * size).reshape(slots, size)
    return out


def slots_of(node: np.ndarray, asked: np.ndarray, level: int) -> np.ndarray:
    """The place of each row's node among the asked ones of a level; -1 for others."""
    place = np.full(2 << level, -1)
    place[asked] = np.arange(len(asked))
    return place.take(node)


def with_siblings(summed: np.ndarray, asked: np.ndarray, parents: np.ndarray | None) -> np.ndarray:
    """Sums of all open nodes from those of the asked ones, one of each pair: the other has what its parent has more."""
    if parents is None:
        return summed
    own, rest = summed, parents - summed
    out = np.empty((2 * len(asked), *summed.shape[1:]))
    is_left = (asked % 2 == 0)[:, None, None, None]
    out[0::2], out[1::2] = np.where(is_left, own, rest), np.where(is_left, rest, own)
    return out


def best_splits(hist: np.ndarray, s: Settings) -> dict[str, np.ndarray]:
    """Of each slot the best (feature, cut), its gain, and the sums of the node and of its left part; feature -1 for none."""
    slots, _, size, _ = hist.shape
    left = hist.cumsum(axis=2)
    total = left[:, :1, -1:]
    right = total - left
    ok = (left[..., 0] >= s.min_leaf) & (right[..., 0] >= s.min_leaf) & (total[..., 0] >= s.min_split)
    score = lambda part: part[..., 1] ** 2 / np.maximum(part[..., 0] + s.l2, 1e-12)
    gain = np.where(ok, score(left) + score(right) - score(total), 0.0).reshape(slots, -1)
    top = gain.max(axis=1)
    first = (gain >= (top - TIE * (1 + top))[:, None]).argmax(axis=1)
    whole = total[:, 0, 0]
    found = top > 1e-9 * (1 + np.abs(whole[:, 1]))
    return {
        "feature": np.where(found, first // size, -1),
        "cut": first % size,
        "gain": gain[np.arange(slots), first],
        "whole": whole,
        "left": left.reshape(slots, -1, 2)[np.arange(slots), first],
    }


class Tree:
    def __init__(self, depth: int):
        size = 2 << depth
        self.feature, self.cut = np.full(size, -1, np.int16), np.zeros(size, np.int16)
        self.gain, self.weight, self.value = np.zeros(size), np.zeros(size), np.zeros(size)

    def split(self, nodes: np.ndarray, found: dict[str, np.ndarray], s: Settings) -> np.ndarray:
        """Enter the splits of these nodes; returns the children that they open."""
        if nodes[0] == 1:
            self.enter(nodes, found["whole"], s)
        own = found["feature"] >= 0
        at, left, whole = nodes[own], found["left"][own], found["whole"][own]
        self.feature[at], self.cut[at], self.gain[at] = found["feature"][own], found["cut"][own], found["gain"][own]
        self.enter(2 * at, left, s)
        self.enter(2 * at + 1, whole - left, s)
        return np.sort(np.concatenate([2 * at, 2 * at + 1]))

    def enter(self, nodes: np.ndarray, sums: np.ndarray, s: Settings) -> None:
        self.weight[nodes] = sums[:, 0]
        self.value[nodes] = s.step * sums[:, 1] / np.maximum(sums[:, 0] + s.l2, 1e-12)

    def smaller(self, nodes: np.ndarray) -> np.ndarray:
        """Of each pair of open siblings the one with less weight."""
        left, right = nodes[0::2], nodes[1::2]
        return np.where(self.weight[left] <= self.weight[right], left, right)

    def route(self, bins: np.ndarray, node: np.ndarray, levels: int = 1) -> np.ndarray:
        """The nodes of rows so many levels further down; a leaf leads to itself, as no bin exceeds its cut."""
        flat, width, place = bins.ravel(), bins.shape[1], np.arange(len(self.feature))
        inner = self.feature >= 0
        start = np.where(inner, self.feature.astype(np.int64) * width, 0)
        left, cut = np.where(inner, 2 * place, place), np.where(inner, self.cut, 255).astype(np.uint8)
        out = np.empty(width, np.int64)
        for a in range(0, width, ROUTED_ROWS):
            rows, now = np.arange(a, min(a + ROUTED_ROWS, width)), node[a : a + ROUTED_ROWS]
            for _ in range(levels):
                at = start.take(now)
                at += rows
                over = flat.take(at) > cut.take(now)
                now = left.take(now)
                now += over
            out[a : a + ROUTED_ROWS] = now
        return out

    def rows(self):
        """(node, feature, cut, value, gain, weight) of every node there is."""
        for node in np.flatnonzero(self.weight > 0).tolist():
            yield node, int(self.feature[node]), int(self.cut[node]), float(self.value[node]), float(self.gain[node]), float(self.weight[node])


def fit(bins: np.ndarray, y: np.ndarray, s: Settings, size: int) -> tuple[np.ndarray, list[list[Tree]]]:
    """Raw start scores and, for each round, a tree of each output."""
    if s.classes:
        first = start(np.bincount(y.astype(np.int64), minlength=s.classes).astype(float), 0.0, s.classes)
    else:
        first = start(np.array([float(len(y))]), float(y.sum()), 0)
    cuts = range(0, len(y), BLOCK_ROWS)
    blocks = [(y[a : a + BLOCK_ROWS], np.ascontiguousarray(bins[:, a : a + BLOCK_ROWS])) for a in cuts]
    raw, rounds = [np.repeat(first[:, None], len(own), 1) for own, _ in blocks], []
    for _ in range(s.iters):
        trees = []
        both = [slopes(own, score, s.classes) for (own, _), score in zip(blocks, raw)]
        for k in range(len(first)):
            tree, nodes, parents = Tree(s.depth), np.array([1]), None
            asked, at = nodes, [np.ones(len(own), np.int64) for own, _ in blocks]
            for level in range(s.depth):
                summed = sum(histogram(b, slots_of(node, asked, level), g[k], h[k], len(asked), size) for (_, b), node, (g, h) in zip(blocks, at, both))
                hist = with_siblings(summed, asked, parents)
                found = best_splits(hist, s)
                nodes = tree.split(nodes, found, s)
                if not len(nodes):
                    break
                asked, parents = tree.smaller(nodes), hist[found["feature"] >= 0]
                at = [tree.route(b, node) for (_, b), node in zip(blocks, at)]
            for score, node in zip(raw, at):
                score[k] += tree.value.take(node)
            trees.append(tree)
        rounds.append(trees)
    return first, rounds
