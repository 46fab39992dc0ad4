"""Substring dedup of bytes by prefix doubling over the positions at which a string may repeat; see `doubling`."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import blocks, doubling
from .symbols import byte_symbols, cover, spans_of

WIDTH, BLOCK = 100, 32


def duplicate_spans(docs: DataFrame, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """(id, key, spans) in bytes, for texts with a string of `width` bytes that also starts earlier."""
    return doubling.repeated(blocks.keyed(docs), byte_symbols, width, block)


def deduplicate(docs: DataFrame, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (binary).

    Strings are compared on the whole input; earlier is a smaller doc_id or, in one text, an earlier start. Null
    texts are empty ones. Null ids come after all others; texts under one id follow by their hash; rows equal in id
    and text count as one. Texts with fewer than `width` bytes stay whole. What is kept may break a character, so it
    is binary. An empty table gives no rows. Other columns are not read. Strings are equal where two 64-bit hashes are.
    """
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def cut(batches):
        for batch in batches:
            out = []
            for doc_id, data, start, end in spans_of(batch):
                if start is None:
                    out.append((doc_id, len(data), 0, 0, data))
                    continue
                gone = cover(start, end, len(data))
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                out.append((doc_id, len(data), len(data) - len(kept), len(edges) // 2, kept))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    rows = blocks.with_spans(blocks.keyed(docs), duplicate_spans(docs, width, block))
    return rows.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
