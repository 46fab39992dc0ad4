"""Substring dedup of words by relative Lempel-Ziv factors against every earlier document.

The blocks of all documents with smaller ids are the reference; `factors` finds the pieces of a document that stand
there, checks windows across the ends of pieces, and parses the document greedily. The words of factors of `WIDTH` or
more words, and of those cut short at a boundary inside such a piece, are duplicate spans.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks, factors
from .common import written
from .symbols import cover, spans_of, word_symbols

WIDTH, BLOCK = 50, 10


def parsed(docs: DataFrame, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """(id, key, factors) of texts with a window of `width` words that starts in a document of smaller id.

    A factor is (start, length, ref_id, ref_key, ref_start) in words; ref_key is `common.text_key` of the text under
    ref_id. Words between factors are literals.
    """
    return factors.factors(factors.pieces(blocks.keyed(docs), word_symbols, width, block))


def duplicate_spans(docs: DataFrame, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """(id, key, spans) in words: the stretches of a text's factors."""
    span = lambda f: F.struct(f["start"].alias("start"), (f["start"] + f["length"]).alias("end"))
    return written(parsed(docs, width, block).select("id", "key", F.transform("factors", span).alias("spans")), "spans", few_files=True)


def deduplicate(docs: DataFrame, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_removed, text (kept words joined by one space).

    Words are what stands between white space (0x20, 0x09 to 0x0D). Null texts are empty ones. Null ids come after
    all others; rows of one id never remove each other's words. Texts with fewer than `width` words stay whole. An
    empty table gives no rows. Other columns are not read. Windows are equal where two 64-bit hashes are.
    """

    def cut(batches):
        for batch in batches:
            out = []
            for doc_id, data, start, end in spans_of(batch):
                words = data.split()
                kept = words
                if start is not None:
                    kept = [w for w, g in zip(words, cover(start, end, len(words)).tolist()) if not g]
                out.append((doc_id, len(words), len(words) - len(kept), b" ".join(kept)))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))] if out else []
            if columns:
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "data"])

    rows = blocks.with_spans(blocks.keyed(docs), duplicate_spans(docs, width, block))
    cut_rows = rows.mapInArrow(cut, "doc_id long, n_words long, n_removed long, data binary")
    return cut_rows.select("doc_id", "n_words", "n_removed", F.col("data").cast("string").alias("text"))
