"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score is the logistic function of w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j. By the sum-of-squares identity
the pairwise part is half the sum over factors of (sum v_if x_i)^2 - sum v_if^2 x_i^2, so it costs one pass over a
text's features. The model is fitted in one task on a sample of labelled rows of bounded size; scoring is a map.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import machine, symbols
from .common import small_batches, whole
from .machine import FACTORS, features, fit, score_text, slots_of

SAMPLE = 20_000
METADATA = ("n_chars",)

register_pickle_by_value(machine)
register_pickle_by_value(symbols)


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def readable(docs: DataFrame, metadata) -> DataFrame:
    """doc_id, data (empty for null), meta: the numbers of the metadata columns."""
    small_batches(docs.sparkSession)
    numbers = F.array(*[F.col(m).cast("double") for m in metadata]) if metadata else F.array().cast("array<double>")
    return docs.select("doc_id", whole().cast("binary").alias("data"), numbers.alias("meta"))


def train(docs: DataFrame, labels: DataFrame, metadata=METADATA, sample: int = SAMPLE):
    """The model from at most `sample` labelled documents that are not held out: those of smallest hash.

    A document with several labels counts by the largest. Rows without label or text of that id are not used.
    """
    size = slots_of(metadata)
    known = labels.where("quality is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    one = known.groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").alias("quality"))
    chosen = one.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = readable(docs, metadata).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("data", "meta", F.xxhash64("_id").alias("place"), F.col("quality").cast("int"))

    def extract(batches):
        for batch in batches:
            got = [features(d, m) for d, m in zip(batch.column("data").to_pylist(), batch.column("meta").to_pylist())]
            arrays = [pa.array([i for i, _ in got], pa.list_(pa.int32())), pa.array([x for _, x in got], pa.list_(pa.float32())), batch.column("quality"), batch.column("place")]
            yield pa.RecordBatch.from_arrays(arrays, ["idx", "x", "y", "place"])

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place", kind="stable")
        w0, w, v = fit(list(zip(frame["idx"], frame["x"])), frame["y"].to_numpy(float), size)
        return pd.DataFrame({"slot": range(-1, size), "w": [w0, *w], "v": [[0.0] * FACTORS, *v.tolist()]})

    extracted = rows.mapInArrow(extract, "idx array<int>, x array<float>, y int, place long")
    model = extracted.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(learn, "slot int, w double, v array<double>").toPandas().sort_values("slot")
    if not len(model):
        return 0.0, np.zeros(size), np.zeros((size, FACTORS))
    return float(model["w"].iloc[0]), model["w"].to_numpy()[1:], np.array(model["v"].tolist())[1:]


def score(docs: DataFrame, model, metadata=METADATA) -> DataFrame:
    """One row per row of `docs`: doc_id and score, the model's chance that the document is good.

    Null texts are empty ones; they and empty texts are scored by their statistics. Null metadata are left out. Rows
    that repeat an id are scored each. An empty table gives no rows.
    """

    def work(batches):
        for batch in batches:
            scores = [score_text(d, m, model) for d, m in zip(batch.column("data").to_pylist(), batch.column("meta").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return readable(docs, metadata).mapInArrow(work, "doc_id long, score double")
