"""The factorisation machine and its features in numpy; travels with the tasks, see `classifier`."""

from __future__ import annotations

import numpy as np

from .symbols import word_symbols

BUCKETS, FACTORS = 1 << 14, 8
EPOCHS, BATCH, RATE, DECAY = 6, 256, 0.05, 1e-6
BINS = 10
SYMBOLS = np.frombuffer(b"#*$%&|<>!", np.uint8)
N_STATS = 11


def statistics(data: bytes, words: np.ndarray) -> np.ndarray:
    """Structure of a text in numbers from 0 to 1."""
    size, n = max(1, len(data)), max(1, len(words))
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    lines = [line for line in data.split(b"\n") if line.strip()]
    values = [
        1 - len(np.unique(words)) / n,
        float((words[1:] == words[:-1]).sum()) / n,
        20 * counts[SYMBOLS].sum() / size,
        20 * counts[ord("|")] / size,
        20 * counts[ord("!")] / size,
        counts[65:91].sum() / size,
        5 * counts[48:58].sum() / size,
        1 - len(set(lines)) / max(1, len(lines)),
        np.log1p(n / max(1, len(lines))) / 8,
        size / n / 20,
        np.log1p(len(words)) / 12,
    ]
    return np.clip(values, 0, 1)


def features(data: bytes, metadata: list) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values: words by hash, each statistic and each metadata number as itself and as a bin."""
    words = word_symbols(data.lower())
    numbers = [*statistics(data, word_symbols(data))]
    known = [m is not None for m in metadata]
    numbers += [min(1.0, np.log1p(max(0, m)) / 16) if m is not None else 0.0 for m in metadata]
    numbers = np.array(numbers)
    used = np.array([True] * N_STATS + known)
    slots = np.unique((words >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1))
    bins = np.minimum((numbers * BINS).astype(np.int64), BINS - 1)
    place = BUCKETS + np.arange(len(numbers)) * (BINS + 1)
    idx = np.concatenate([slots, place[used], (place + 1 + bins)[used]])
    value = np.concatenate([np.full(len(slots), 1 / np.sqrt(max(1, len(slots)))), numbers[used], np.ones(int(used.sum()))])
    return idx.astype(np.int32), value.astype(np.float32)


def slots_of(metadata) -> int:
    return BUCKETS + (N_STATS + len(metadata)) * (BINS + 1)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, seed: int = 3) -> tuple[float, np.ndarray, np.ndarray]:
    """w0, w, v by AdaGrad on the logistic loss, both labels with the same total weight; without both the prior alone."""
    rng = np.random.default_rng(seed)
    prior = (y.sum() + 1) / (len(y) + 2)
    w0, w, v = 0.0, np.zeros(size), rng.normal(0, 0.05, (size, FACTORS))
    if not 0 < y.sum() < len(y):
        return float(np.log(prior / (1 - prior))), w, np.zeros_like(v)
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    gw, gv, g0 = np.full(size, 1e-6), np.full((size, FACTORS), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            own = order[at : at + BATCH]
            idx = np.concatenate([rows[i][0] for i in own])
            x = np.concatenate([rows[i][1] for i in own]).astype(float)
            starts = np.cumsum([0, *(len(rows[i][0]) for i in own[:-1])])
            of = np.repeat(np.arange(len(own)), np.diff(np.append(starts, len(idx))))
            vx = v[idx] * x[:, None]
            sums = np.add.reduceat(vx, starts)
            score = w0 + np.add.reduceat(w[idx] * x, starts) + 0.5 * (sums**2 - np.add.reduceat(vx**2, starts)).sum(1)
            error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - y[own]) * weight[own] / len(own)
            slots, inverse = np.unique(idx, return_inverse=True)
            dw = np.bincount(inverse, error[of] * x) + DECAY * w[slots]
            each = error[of, None] * x[:, None] * (sums[of] - vx)
            dv = np.stack([np.bincount(inverse, each[:, f]) for f in range(FACTORS)], 1) + DECAY * v[slots]
            gw[slots] += dw**2
            gv[slots] += dv**2
            g0 += error.sum() ** 2
            w[slots] -= RATE * dw / np.sqrt(gw[slots])
            v[slots] -= RATE * dv / np.sqrt(gv[slots])
            w0 -= RATE * error.sum() / np.sqrt(g0)
    return w0, w, v


def score_text(data: bytes, metadata: list, model) -> float:
    w0, w, v = model
    idx, x = features(data, metadata)
    vx = v[idx] * x[:, None]
    z = w0 + float(w[idx] @ x) + 0.5 * float((vx.sum(0) ** 2 - (vx**2).sum(0)).sum())
    return 1 / (1 + np.exp(-min(30.0, max(-30.0, z))))
