"""Overlapping regex scans of texts for hashed word runs; travels with the tasks, see `resampling`."""

from __future__ import annotations

import zlib

import numpy as np
import regex

SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
# A-Z to a-z, every separator to a space; bytes of characters beyond ASCII stay
PLAIN = bytes(32 if c in SEPARATORS else c + 32 if 65 <= c <= 90 else c for c in range(256))


def collapsed(data: bytes) -> bytes:
    """The words of UTF-8 text between single spaces, one before the first and one after the last; empty without words."""
    words = data.translate(PLAIN).split()
    return b" " + b" ".join(words) + b" " if words else b""


def patterns(n: int) -> list:
    """For runs of 1 to n words: a space, the words, and a look at the space behind, which the next match may start with."""
    return [regex.compile(rb" [^ ]++" * k + rb"(?= )") for k in range(1, n + 1)]


def buckets(text: bytes, scans: list, size: int) -> np.ndarray:
    """The bucket of every word run of a `collapsed` text, repeats included, shorter runs first."""
    crc = zlib.crc32
    spans = (m.span() for scan in scans for m in scan.finditer(text, overlapped=True))
    return np.fromiter((crc(text[start + 1 : end]) % size for start, end in spans), np.int32)
