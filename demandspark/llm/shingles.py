"""Token sets of texts and their hashes; travels with the tasks, see `jaccard`."""

from __future__ import annotations

import numpy as np

from .symbols import Rolling, mixed, word_symbols

# factors that make other orders of the same tokens
ORDERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def tokens(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; with fewer words the whole sequence is one."""
    words = word_symbols(text.lower())  # of bytes: A-Z only
    size = min(n, len(words))
    if not size:
        return np.zeros(0, np.uint64)
    grams = mixed(Rolling(words).window(np.arange(len(words) - size + 1), size) + np.uint64(size))
    return np.unique(grams)


def prefix(n: int, percent: int) -> int:
    return n + (-percent * n // 100) + 1 if n else 0


def set_id(found: np.ndarray) -> int:
    """A hash of the set as a whole."""
    total = np.sum(mixed(found ^ ORDERS[0]), dtype=np.uint64), np.sum(mixed(found ^ ORDERS[1]), dtype=np.uint64)
    value = mixed(np.array([total[0]], np.uint64) ^ mixed(np.array([total[1] + np.uint64(len(found))], np.uint64)))
    return int(value.view(np.int64)[0])
