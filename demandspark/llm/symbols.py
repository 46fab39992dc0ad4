"""Numpy work on texts as arrays of symbols (words or bytes); it travels with the tasks, see `blocks`.

All of it handles one segment of symbols at a time, whatever the length of a text.
"""

from __future__ import annotations

import numpy as np

SEGMENT = 1 << 18  # a power of two
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

_powers: dict = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values; the shifts and factors are the published splitmix64 ones."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd factor modulo 2^64 from 0 to n - 1, and of its inverse."""
    if len(_powers.get("up", ())) < n:
        factor = int(MULTIPLIER) ^ 0x5851F42D00000000
        for name, base in (("up", factor), ("down", pow(factor, -1, 2**64))):
            steps = np.full(max(n, SEGMENT + 4096), base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"][:n], _powers["down"][:n]


class Rolling:
    """Hash of any stretch of a symbol array, from prefix sums."""

    def __init__(self, symbols: np.ndarray):
        up, self.down = powers(len(symbols) + 1)
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * up[: len(symbols)], out=self.sums[1:])

    def window(self, at, size):
        return (self.sums[at + size] - self.sums[at]) * self.down[at]


def byte_symbols(data: bytes) -> np.ndarray:
    return BYTE[np.frombuffer(data, np.uint8)]


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of UTF-8 text, that is of runs without 0x20 and 0x09 to 0x0D."""
    raw = np.frombuffer(data, np.uint8)
    word = np.zeros(len(raw) + 2, np.int8)
    word[1:-1] = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.diff(word)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def pieces_at_space(data: bytes, most: int = SEGMENT):
    """Long text in pieces that end at white space where there is some."""
    at = 0
    while len(data) - at > most:
        end = max(data.rfind(c, at, at + most) for c in (b" ", b"\n"))
        end = at + most if end <= at else end
        if end == at + most:  # a word longer than a piece
            ends = [e for e in (data.find(c, end) for c in (b" ", b"\n")) if e >= 0]
            end = min(ends, default=len(data))
        yield data[at:end]
        at = end
    yield data[at:]


def word_symbols(data: bytes) -> np.ndarray:
    """One 64-bit value for each word."""
    out = []
    for piece in pieces_at_space(data):
        starts, ends = word_bounds(piece)
        out.append(mixed(Rolling(byte_symbols(piece)).window(starts, ends - starts)))
    return out[0] if len(out) == 1 else np.concatenate(out)


def segments(texts: list[bytes], symbols_of, width: int):
    """(row numbers, offsets in their text, bounds in the segment, symbols) of stretches that hold all windows.

    Texts are put together up to `SEGMENT` symbols; longer ones are cut, each cut sharing width - 1 symbols.
    """
    rows, offsets, bounds, held, size = [], [], [0], [], 0
    for row, text in enumerate(texts):
        symbols = symbols_of(text)
        for at in range(0, max(1, len(symbols) - width + 1), SEGMENT - width):
            part = symbols[at : at + SEGMENT - 1]
            if len(part) < width:
                continue
            if size + len(part) > SEGMENT:
                yield rows, offsets, bounds, np.concatenate(held)
                rows, offsets, bounds, held, size = [], [], [0], [], 0
            size += len(part)
            rows.append(row)
            offsets.append(at)
            bounds.append(size)
            held.append(part)
    if held:
        yield rows, offsets, bounds, np.concatenate(held)


def first_smallest(keys: np.ndarray, w: int) -> np.ndarray:
    """For each w keys in a row the place of the smallest one, the first of equals; at most `SEGMENT` keys."""
    low = np.uint64(SEGMENT - 1)
    least = (keys & ~low) | np.arange(len(keys), dtype=np.uint64)
    span = 1
    while 2 * span <= w:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < w:
        least = np.minimum(least[: len(least) - (w - span)], least[w - span :])
    return (least & low).astype(np.int64)


def runs(bounds: list[int], symbols: np.ndarray, width: int, k: int):
    """Arrays: number of the text, first window and number of windows of each run, its block's place from the first
    window on, the block, the context that all windows cover, and both sides of the block in 32 bits each."""
    rolling = Rolling(symbols)
    grams = mixed(rolling.window(np.arange(len(symbols) - k + 1), k))
    smallest = first_smallest(grams, width - k + 1)
    edges = np.asarray(bounds)
    inside = np.ones(len(smallest), bool)
    for edge in edges[1:-1]:
        inside[edge - width + 1 : edge] = False
    at = np.flatnonzero(inside)
    where = smallest[at]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (np.diff(where) != 0)
    begin = np.flatnonzero(new)
    start, count, place = at[begin], np.diff(np.append(begin, len(at))), where[begin]
    shape = ((place - start) << 20 | count).astype(np.uint64)
    context = mixed(rolling.window(start, count + width - 1) ^ mixed(shape))
    # sides that no window of the run covers are hashes of anything; nobody asks for them
    size = (width - k) // 2
    left = mixed(rolling.window(np.maximum(place - size, 0), size))
    right = mixed(rolling.window(np.minimum(place + k, len(symbols) - size), size))
    sides = left >> np.uint64(32) << np.uint64(32) | right >> np.uint64(32)
    text = np.searchsorted(edges, start, "right") - 1
    return text, start - edges[text], count, place - start, grams[place], context, sides


def cover(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which of n symbols lie in a span."""
    steps = np.bincount(start, minlength=n + 1) - np.bincount(end, minlength=n + 1)
    return np.cumsum(steps[:-1]) > 0


def spans_of(batch):
    """(doc_id, data, starts, ends) of each row of an Arrow batch of `blocks.with_spans`; None for starts and ends without spans."""
    lists = batch.column("spans")
    values = lists.values
    start, end = (values.field(c).to_numpy(zero_copy_only=False) for c in ("start", "end"))
    offsets = lists.offsets.to_numpy()
    for k, (doc_id, data) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("data"))):
        low, high = offsets[k], offsets[k + 1]
        yield (doc_id, data.as_py(), start[low:high], end[low:high]) if lists[k].is_valid and high > low else (doc_id, data.as_py(), None, None)
