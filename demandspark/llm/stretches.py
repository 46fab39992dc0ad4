"""Numpy work of `doubling` on stretches of bytes around cores; it travels with the tasks."""

from __future__ import annotations

import numpy as np

from .symbols import BYTE, Rolling, mixed


def laid_out(stretches: list[bytes], before: np.ndarray, reach: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """One line of `reach + size + reach` bytes per stretch, all cores in one column, and which of them there are."""
    line = np.arange(2 * reach + size)
    low = (reach - before)[:, None]
    inside = (line >= low) & (line < low + np.array([len(s) for s in stretches])[:, None])
    out = np.zeros(inside.shape, np.uint8)
    out[inside] = np.frombuffer(b"".join(stretches), np.uint8)
    return out, inside


def agreement(mine, other, reach: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """How many bytes before and after equal cores agree; -1 where the cores differ."""
    equal = (mine[0] == other[0]) & mine[1] & other[1]
    core = equal[:, reach : reach + size].all(1)
    before = np.cumprod(equal[:, :reach][:, ::-1], axis=1).sum(1)
    after = np.cumprod(equal[:, reach + size :], axis=1).sum(1)
    return np.where(core, before, -1), np.where(core, after, -1)


def names(lines: np.ndarray, row: np.ndarray, column: np.ndarray, length: int, parts: int) -> list[np.ndarray]:
    """Hashes of the `parts` neighbouring stretches of `length` bytes from (row, column) on."""
    rolling = Rolling(BYTE[lines.reshape(-1)])
    at = row * lines.shape[1] + column
    return [mixed(rolling.window(at + k * length, length)).view(np.int64) for k in range(parts)]
