"""Importance resampling towards a target distribution by hashed word runs.

Separators collapse to single spaces, and an overlapping regex scan gives the span of every run of 1 to n words, whose
CRC is counted. The scan runs once: a text's buckets are written, and counts and weights are made from them. A bucket
gains where the target holds more of it than the corpus does; a text weighs the mean gain of its runs. Gumbel noise
by the id makes the draw of the highest scores a sample without replacement.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distributed import number_rows
from . import features
from .common import drop, small_batches, whole, written

N, BUCKETS, SEED = 2, 10_000, 7
MIN_WORDS, SHARE = 20, 25
PIECE = 1 << 20  # bytes of buckets in a batch

register_pickle_by_value(features)


def hashed(rows: DataFrame, n: int = N, size: int = BUCKETS) -> DataFrame:
    """(id, n_words, buckets) of every row with an id and a text; the buckets of its runs of 1 to n words as bytes."""
    code = code_of(size)

    def work(batches):
        scans = features.patterns(n)
        for batch in batches:
            held, amount = [], 0
            for row, value in zip(batch.column("id").to_pylist(), batch.column("data")):
                text = features.collapsed(value.as_py())
                own = features.buckets(text, scans, size).astype(code).tobytes()
                held.append((row, max(0, text.count(b" ") - 1), own))
                amount += len(own)
                if amount > PIECE:
                    yield joined(held)
                    held, amount = [], 0
            if held:
                yield joined(held)

    def joined(held):
        types = (pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*held), types)], ["id", "n_words", "buckets"])

    small_batches(rows.sparkSession)
    return rows.select(F.col("id").cast("long").alias("id"), whole().cast("binary").alias("data")).mapInArrow(work, "id long, n_words long, buckets binary")


def code_of(size: int) -> str:
    """How a bucket is kept."""
    return "<u2" if size <= 1 << 16 else "<u4"


def counts(table: DataFrame, size: int = BUCKETS) -> np.ndarray:
    """How many runs of all texts are in each bucket; each task counts for itself, `size` numbers reach the driver."""
    code = code_of(size)

    def work(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(np.frombuffer(value.as_py(), code), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["bucket", "n"])

    each = table.select("buckets").mapInArrow(work, "bucket int, n long")
    out = np.zeros(size, np.int64)
    for row in each.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(share in the target / share in the source)) of each bucket, each count plus one."""
    size = len(source)
    up = (target + 1.0) * float(source.sum() + size)
    down = (source + 1.0) * float(target.sum() + size)
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def weighed(table: DataFrame, gain: np.ndarray) -> DataFrame:
    """(id, n_words, n_features, weight); the weight is the mean gain rounded down, 0 for a text without words."""
    code = code_of(len(gain))

    def work(batches):
        for batch in batches:
            found = [np.frombuffer(value.as_py(), code) for value in batch.column("buckets")]
            sizes = [len(own) for own in found]
            weights = [int(gain[own].sum()) // len(own) if len(own) else 0 for own in found]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_words"), pa.array(sizes, pa.int64()), pa.array(weights, pa.int64())], ["id", "n_words", "n_features", "weight"])

    return table.select("id", "n_words", "buckets").mapInArrow(work, "id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, n: int = N, size: int = BUCKETS, seed: int = SEED, min_words: int = MIN_WORDS, share: int = SHARE) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_features, weight, score, rank.

    Words are runs of letters, digits and characters beyond ASCII, A-Z in lower case; only the column `text` of
    `target` is read. Of the rows with at least `min_words` words the `share` per cent with the highest scores, rounded
    down, have ranks from 1 on; equal scores rank by the smaller doc_id, null ids last. Null and empty texts have no
    words and weight 0. Rows that repeat a doc_id or a text count, and are drawn, each for itself. A null id draws its
    noise as an empty one. Without target texts all gains follow the corpus alone; an empty `docs` gives no rows. Other
    columns are not read.
    """
    table = written(hashed(docs.select(F.col("doc_id").alias("id"), "text"), n, size), "features")
    aims = written(hashed(target.select(F.lit(0).alias("id"), "text"), n, size), "target-features")
    gain = gains(counts(table, size), counts(aims, size))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = written(weighed(table, gain).withColumn("score", F.col("weight") + noise), "scores")
    drop(table, aims)
    enough = F.col("n_words") >= min_words
    drawn = share * scored.where(enough).count() // 100
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("weight"), F.asc("n_features")]
    ranked = number_rows(scored.where(enough), order, "place").withColumn("rank", F.when(F.col("place") <= drawn, F.col("place"))).drop("place")
    both = ranked.unionByName(scored.where(~enough).withColumn("rank", F.lit(None).cast("long")))
    return both.select(F.col("id").alias("doc_id"), "n_words", "n_features", "weight", "score", "rank")
