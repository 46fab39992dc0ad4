"""Blocks that texts pick themselves, as an index of repeated windows of symbols (words or bytes).

Of each window of `width` symbols the smallest of its hashed k-grams is its block. Equal windows have equal blocks,
and neighbouring windows mostly share theirs, so a text has about one block in (width - k) / 2 symbols. Windows that
follow each other with the same block are a run. `factors` (words) and `doubling` (bytes) start from runs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import symbols
from .common import small_batches, whole
from .symbols import runs, segments

LAST = 2**63 - 1

# the numpy work travels with the tasks, so executors need no copy of this package
register_pickle_by_value(symbols)

RUN = "id long, key long, start long, count int, place int, block long, context long, sides long"
RUN_COLUMNS = tuple(kind.split()[0] for kind in RUN.split(", "))


def run_rows(docs: DataFrame, symbols_of, width: int, k: int, columns: tuple[str, ...] = RUN_COLUMNS) -> DataFrame:
    """All runs of all texts as rows of these columns; `docs` has id, key and data (the text's bytes)."""

    def work(batches):
        for batch in batches:
            ids, keys = (np.array(batch.column(c).to_numpy(zero_copy_only=False)) for c in ("id", "key"))
            for rows, offsets, bounds, values in segments(batch.column("data").to_pylist(), symbols_of, width):
                text, start, count, place, block, context, sides = runs(bounds, values, width, k)
                row = np.asarray(rows)[text]
                found = [ids[row], keys[row], start + np.asarray(offsets)[text], count.astype(np.int32), place.astype(np.int32)]
                found += [x.view(np.int64) for x in (block, context, sides)]
                wanted = dict(zip(RUN_COLUMNS, found))
                yield pa.RecordBatch.from_arrays([pa.array(wanted[c]) for c in columns], list(columns))

    schema = ", ".join(kind for kind in RUN.split(", ") if kind.split()[0] in columns)
    return docs.select("id", "key", "data").mapInArrow(work, schema)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, id (null ids last), key (of the text), data (UTF-8, empty for null); rows equal in both are one row."""
    small_batches(docs.sparkSession)
    text = whole()
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), F.xxhash64(text).alias("key"), text.cast("binary").alias("data"))


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, data and spans (null: none) of every text."""
    side = spans.select(F.col("id").alias("_id"), F.col("key").alias("_key"), "spans")
    joined = docs.join(side, (F.col("id") == F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    return joined.select("doc_id", "data", "spans")
