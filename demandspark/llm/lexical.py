"""Ranked lexical search by a frequency-ordered trie of documents.

Items name the terms that matter. Documents become vectors of those terms with their frequencies, written once; counts
over them give N, L and every df. Then each task cuts its vectors into blocks, sorts a block's vectors into a trie, the
most frequent terms first, and runs each item through it depth first: largest tf and smallest m below a node bound every
score there, and a subtree that can't reach the item's best rows so far is skipped. An item's best rows go from block to
block, so a task returns `top` rows an item, which are merged by item in two steps.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import features, trie
from .common import ascii_lower, drop, extract_all, small_batches, whole, written
from .decontaminate import WORD

TOP = 50
ITEM_TERMS = 100_000  # terms of a block of items: what a task holds of them
BLOCK, CELLS = 4096, 1 << 25  # documents of a trie, and its nodes times terms
PARTS = 64
LAST = 2**63 - 1

register_pickle_by_value(features)
register_pickle_by_value(trie)


def vectors(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, tfs) of every row: its number of terms, and frequencies of the given ones, the ids ascending."""

    def work(batches):
        number = terms.get
        for batch in batches:
            ids, n, own, tfs, ends = batch.column("id"), [], [], [], [0]
            for value in batch.column("data"):
                words = value.as_py().translate(features.PLAIN).split()
                found = np.array([k for k in map(number, words) if k is not None], np.int32)
                kept, tf = np.unique(found, return_counts=True)
                n.append(len(words))
                own.append(kept)
                tfs.append(tf)
                ends.append(ends[-1] + len(kept))
            if n:
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(x).astype(np.int32))) for x in (own, tfs)]
                yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), *lists], ["id", "n", "terms", "tfs"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), whole().cast("binary").alias("data"))
    return rows.mapInArrow(work, "id long, n long, terms array<int>, tfs array<int>")


def searched(table: DataFrame, items: list[tuple[int, np.ndarray]], weight: np.ndarray, rank: np.ndarray, total: int, length: int, top: int) -> DataFrame:
    """(item, doc_id, score): of each task the `top` rows of every item; `rank` orders the terms by frequency."""
    block = max(4 * trie.LEAF, min(BLOCK, CELLS // max(1, len(weight))))

    def blocks(batches):
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                if size + part.num_rows > block and held:
                    yield held
                    held, size = [], 0
                held.append(part)
                size += part.num_rows
        if held:
            yield held

    def numbers(held, name: str, lists: bool = False) -> np.ndarray:
        column = [b.column(name).flatten() if lists else b.column(name) for b in held]
        return np.concatenate([c.to_numpy(zero_copy_only=False) for c in column]).astype(np.int64)

    def work(batches):
        found = {item: trie.Best(top) for item, _ in items}
        for held in blocks(batches):
            sizes = np.concatenate([b.column("terms").value_lengths().to_numpy(zero_copy_only=False) for b in held]).astype(np.int64)
            of = np.repeat(np.arange(len(sizes)), sizes)
            ranks = rank[numbers(held, "terms", True)]
            order = np.lexsort((ranks, of))
            some = sizes > 0
            if not some.any():
                continue
            ids, n = numbers(held, "id")[some], numbers(held, "n")[some]
            m = np.array([50 + 50 * x * total // length for x in n.tolist()], np.int64)
            tree = trie.Trie(ids, m, sizes[some], ranks[order], numbers(held, "tfs", True)[order], weight)
            for item, own in items:
                tree.search(own, found[item])
        for item, best in found.items():
            if len(best.ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best.ids), item)), pa.array(best.ids), pa.array(best.scores)], ["item", "doc_id", "score"])

    return table.mapInArrow(work, "item long, doc_id long, score long")


def top_rows(rows: DataFrame, top: int) -> DataFrame:
    """The `top` best rows by item with their rank; first within parts of an item, so that none is gathered whole."""
    order = [F.desc("score"), F.asc("doc_id")]
    parts = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    some = parts.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= top).drop("rank", "part")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)


def search(docs: DataFrame, benchmark: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` best documents of every item with a score above 0.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z in lower case. Every row of `benchmark` is an
    item and every row of `docs` a document, also where ids or texts repeat. Null and empty texts have no terms: such
    items find nothing and such documents don't count. Equal scores rank by the smaller doc_id, null ids last. Without
    documents or items there are no rows. Other columns are not read.

    Items are searched in blocks of about `ITEM_TERMS` terms, each with a pass over the documents of its own, so more
    items cost passes, not memory.
    """
    items = written(benchmark.select(F.monotonically_increasing_id().alias("item"), "item_id", F.array_distinct(extract_all(ascii_lower(whole()), WORD)).alias("terms")), "items", few_files=True)
    named = items.where(F.size("terms") > 0)
    count = named.agg(F.sum(F.size("terms"))).first()[0]
    found = []
    blocks = -(-(count or 0) // ITEM_TERMS)
    for block in range(blocks):
        asked = named.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).orderBy("item").collect()
        numbers: dict[bytes, int] = {}
        own = [(r["item"], np.array([numbers.setdefault(t.encode(), len(numbers)) for t in r["terms"]], np.int64)) for r in asked]
        table = written(vectors(docs, numbers), "vectors")
        total, length = table.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(numbers), np.int64)
        for row in table.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[row["term"]] = row["count"]
        order = np.lexsort((np.arange(len(df)), -df))
        rank = np.empty(len(df), np.int64)
        rank[order] = np.arange(len(df))
        weight = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(k) + 1))) for k in df[order]], np.int64)
        ranked = [(item, rank[terms]) for item, terms in own]
        found.append(written(searched(table.where(F.size("terms") > 0), ranked, weight, rank, total, length, top), "found", few_files=True))
        drop(table)
    if not found:
        return items.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    best = top_rows(reduce(DataFrame.unionAll, found), top)
    named = items.select(F.col("item").alias("_item"), "item_id")
    return best.join(named, F.col("item") == F.col("_item")).select("item_id", "rank", F.nullif("doc_id", F.lit(LAST)).alias("doc_id"), "score")
