"""Numpy work of `factors`: hashes of growing stretches, and the greedy parse; it travels with the tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

STEP = np.uint64(0xD6E8FEB86659FD93)
FIELDS = ("start", "end", "ref_id", "ref_key", "ref_start")


def prefix_hashes(lists: pa.ListArray, most: int) -> np.ndarray:
    """Row i, column j: hash of the first j values of list i (those there are)."""
    offsets = lists.offsets.to_numpy()
    size = np.diff(offsets)
    held = np.zeros((len(size), most), np.uint64)
    held[np.arange(most) < size[:, None]] = lists.flatten().to_numpy().view(np.uint64)
    out = np.zeros((len(size), most + 1), np.uint64)
    for j in range(most):
        out[:, j + 1] = (out[:, j] ^ held[:, j]) * STEP
        out[:, j + 1] ^= out[:, j + 1] >> np.uint64(29)
    return out


def merged(row: np.ndarray, start: np.ndarray, end: np.ndarray, ref_id: np.ndarray, ref_key: np.ndarray, ref_start: np.ndarray):
    """Pieces on one diagonal of one reference that touch or overlap, put together; sorted by row and start, longest first."""
    shift = ref_start - start
    order = np.lexsort((start, shift, ref_key, ref_id, row))
    row, start, end, ref_id, ref_key, shift = (c[order] for c in (row, start, end, ref_id, ref_key, shift))
    new = np.ones(len(row), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in (row, ref_id, ref_key, shift)], axis=0)
    # the furthest end so far within each group, by lifting each group above the one before
    lift = np.cumsum(new) * (int(end.max(initial=0)) + 1)
    reach = np.maximum.accumulate(end + lift) - lift
    new[1:] |= start[1:] > reach[:-1]
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(row)) - 1
    out = [row[begin], start[begin], reach[last], ref_id[begin], ref_key[begin], start[begin] + shift[begin]]
    order = np.lexsort((out[4], out[3], -out[2], out[1], out[0]))
    return [c[order] for c in out]


def greedy(lists: pa.ListArray) -> pa.ListArray:
    """The factors of each row's pieces: from the next word on, the piece that holds it and reaches furthest."""
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    columns = [c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten()]
    found = merged(row, *columns)
    row, start, end = (c.tolist() for c in found[:3])
    taken, begins, sizes = [], [], np.zeros(len(lists), np.int64)
    k = 0
    while k < len(row):
        own, best, at = row[k], k, start[k]
        while True:
            while k < len(row) and row[k] == own and start[k] <= at:
                best = k if end[k] > end[best] else best
                k += 1
            if end[best] > at:
                taken.append(best)
                begins.append(at)
                sizes[own] += 1
                at = end[best]
            elif k < len(row) and row[k] == own:
                best, at = k, start[k]
            else:
                break
    taken, begins = np.array(taken, np.int64), np.array(begins, np.int64)
    values = [begins, found[2][taken] - begins, found[3][taken], found[4][taken], found[5][taken] + begins - found[1][taken]]
    structs = pa.StructArray.from_arrays([pa.array(v) for v in values], ["start", "length", "ref_id", "ref_key", "ref_start"])
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), structs)
