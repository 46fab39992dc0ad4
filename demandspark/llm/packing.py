"""Best-fit packing by hierarchical residual packing.

Documents become token ids, longer ones are cut into pieces of a sequence's length. Nodes of bounded size pack their
pieces by best fit, largest first. Bins that are nearly full are emitted; the underfull ones go on, as items with
their content, to fewer nodes, which pack them by best fit again, until one node is left or a round no longer
lowers their number. No node holds more than `node` items, so neither a task nor the driver grows with the input.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bins, tokens
from .bins import best_fit
from .common import small_batches, whole, written
from .tokens import Encoder, chunks

LENGTH, NODE, SLACK = 2048, 20_000, 16

register_pickle_by_value(bins)
register_pickle_by_value(tokens)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
BINS = "node int, bin long, fill int, pieces array<struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long>>"


def pieces(docs: DataFrame, vocabulary: str, length: int = LENGTH, end: int = 0, with_ids: bool = False) -> DataFrame:
    """Per document (null: empty text) its ids, then `end`, cut into pieces of `length`; `ids` too if asked for."""

    def cut(batches):
        encoder = Encoder(vocabulary)
        try:
            for batch in batches:
                rows = batch.to_pydict()
                for texts, ids in chunks(rows["text"], rows["doc_id"]):
                    found = [piece for doc_id, own in zip(ids, encoder.texts(texts, end)) for piece in pieces_of(doc_id, own)]
                    columns = [pa.array(column, kind) for column, kind in zip(zip(*found), types)]
                    yield pa.RecordBatch.from_arrays(columns[: len(names)], names)
        finally:
            encoder.close()

    def pieces_of(doc_id, own: bytes):
        for k, at in enumerate(range(0, len(own), 4 * length)):
            part = own[at : at + 4 * length]
            yield doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), np.frombuffer(part, "<i4")

    small_batches(docs.sparkSession)
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()) if with_ids else pa.null())
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if with_ids else 5]
    if not with_ids:
        types = types[:5]
    rows = docs.select(F.col("doc_id").cast("long"), whole().alias("text"))
    return rows.mapInArrow(cut, PIECES + (", ids array<int>" if with_ids else ""))


def pack_node(length: int, level: int):
    """A function that gives the bins of one node from its items (fill, pieces): the pieces of merged items follow each other."""

    def work(items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["fill", "bin"], ascending=[False, True], kind="stable")
        made: dict[int, list] = {}
        for chosen, held in zip(best_fit(items["fill"].to_numpy(), length), items["pieces"]):
            made.setdefault(chosen, []).extend(held)
        node = int(items["node"].iloc[0])
        fills = [sum(p["length"] for p in held) for held in made.values()]
        return pd.DataFrame({"node": node, "bin": [level << 56 | node << 32 | k for k in made], "fill": fills, "pieces": list(made.values())})

    return work


def pack(items: DataFrame, length: int = LENGTH, node: int = NODE, slack: int = SLACK) -> DataFrame:
    """Place pieces (doc_id, piece, start, length, ids_crc32) in sequences: the same rows with sequence_id, offset.

    Offsets are gapless from 0 in a sequence. A bin with at most `slack` tokens of room is emitted at once. Pieces of
    a repeated doc_id are separate items; null doc_ids are kept; no pieces give no sequences.
    """
    spark = items.sparkSession
    items = written(items, "pieces")
    held = F.struct("doc_id", "piece", "start", "length", "ids_crc32")
    # places in a written table: unique also for equal rows, and the same whenever a task is run again
    bins = items.select(F.monotonically_increasing_id().alias("bin"), F.col("length").cast("int").alias("fill"), F.array(held).alias("pieces"))
    done, level, before = [], 0, None
    while True:
        open_bins = bins.where(f"fill < {length}")
        total = open_bins.count()
        if level == 0:
            done.append(bins.where(f"fill = {length}").select("bin", "pieces"))
        if total == 0 or before is not None and total > 0.95 * before:
            done.append(open_bins.select("bin", "pieces"))
            break
        nodes = -(-total // node)
        dealt = open_bins.select(F.pmod(F.xxhash64("bin", F.lit(level)), F.lit(nodes)).cast("int").alias("node"), "bin", "fill", "pieces")
        level += 1
        packed = dealt.groupBy("node").applyInPandas(pack_node(length, level), BINS)
        packed = written(packed, f"bins-{level}", few_files=True)
        if nodes == 1:
            done.append(packed.select("bin", "pieces"))
            break
        done.append(packed.where(f"fill >= {length - slack}").select("bin", "pieces"))
        bins, before = packed.where(f"fill < {length - slack}").select("bin", "fill", "pieces"), total
    placed = done[0]
    for more in done[1:]:
        placed = placed.unionAll(more)
    offsets = F.transform("pieces", lambda p, i: F.aggregate(F.slice("pieces", F.lit(1), i), F.lit(0).cast("long"), lambda a, q: a + q["length"]))
    each = F.inline(F.arrays_zip(F.col("pieces").alias("held"), offsets.alias("offset")))
    return placed.select("bin", each).select("held.*", F.col("bin").alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, vocabulary: str, length: int = LENGTH, node: int = NODE) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece, the closing id alone. Rows that repeat a doc_id or a text are documents of
    their own. Columns other than doc_id and text are not read. An empty table gives no rows.
    """
    return pack(pieces(docs, vocabulary, length), length, node)


def sequences(docs: DataFrame, vocabulary: str, length: int = LENGTH) -> DataFrame:
    """The packed token ids themselves, (sequence_id, ids), for documents whose doc_ids are unique."""
    packed = pack_documents(docs, vocabulary, length).select(F.col("doc_id").alias("_id"), F.col("piece").alias("_piece"), "sequence_id", "offset")
    full = pieces(docs, vocabulary, length, with_ids=True)
    joined = full.join(packed, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("piece") == F.col("_piece")))
    parts = joined.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
