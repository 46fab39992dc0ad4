"""Relative Lempel-Ziv factors of word sequences against the blocks of all documents with smaller ids.

Index: every window of `width` words picks a block (its smallest hashed k-gram, see `blocks`); blocks that stand in two
documents are the reference. A document meets it in three steps, each giving pieces, that is stretches of at least
`width` words that also stand in a document of smaller id, with the place there:

1. runs of windows that equal an indexed run as a whole;
2. other runs: the block with the words on one side names a core, and the core grows word by word to both sides
   against the first document that holds it, until a word differs;
3. windows across the ends of such pieces, where a core has more holders than the two that step 2 has compared: by
   hash against the windows of all holders, leaving out what lies inside a piece already.

The greedy parse then goes through each document from left to right: of the pieces that hold the next word it takes
the one that reaches furthest, as the factor from that word on. Words in no piece are literals.

Step 3 may leave out windows inside a piece: the first holder of a window has it in no piece, so it is always asked.
A core with any number of holders costs one comparison and at most `width` window rows for each of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks, parse, symbols
from .common import drop, written
from .symbols import Rolling, mixed

register_pickle_by_value(parse)

ROWS = 10_000  # of contexts in one Arrow batch
REF = ("ref_id", "ref_key", "ref_start")
CORE = "id long, key long, at long, from long, n int, rank long, holders long, is_ref boolean, core long, left array<long>, right array<long>"
WINDOW = "id long, key long, start long, a long, b long"


def side_sizes(width: int, k: int) -> tuple[int, int, int]:
    """Words of one side of a block, of a core, and the most that a window reaches beyond a core."""
    side = (width - k) // 2
    return side, k + side, width - k - side


def context_rows(asked: DataFrame, symbols_of, width: int, k: int) -> DataFrame:
    """Hash of each core asked for and the words on both sides of it, the nearest first; `asked` has id, key, data, todo."""
    _, size, reach = side_sizes(width, k)
    names = [kind.split()[0] for kind in CORE.split(", ")]
    steps = np.arange(reach)

    def lists(values, at):
        inside = (at >= 0) & (at < len(values))
        offsets = np.append(0, np.cumsum(inside.sum(1))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[at[inside]].view(np.int64)))

    def work(batches):
        for batch in batches:
            for id_, key, data, todo in zip(*(batch.column(c).to_pylist() for c in ("id", "key", "data", "todo"))):
                values = symbols_of(data)
                todo.sort(key=lambda t: t["at"])
                part = symbols.SEGMENT - size
                for low in range(0, len(values), part):
                    rolling = None
                    own = [t for t in todo if low <= t["at"] < low + part]
                    for k_ in range(0, len(own), ROWS):
                        some = own[k_ : k_ + ROWS]
                        rolling = rolling or Rolling(values[low : low + part + size])
                        at = np.array([t["at"] for t in some])
                        columns = [pa.array(np.full(len(some), id_)), pa.array(np.full(len(some), key)), pa.array(at)]
                        columns += [pa.array([t[c] for t in some], kind) for c, kind in (("from", pa.int64()), ("n", pa.int32()), ("rank", pa.int64()), ("holders", pa.int64()), ("is_ref", pa.bool_()))]
                        columns.append(pa.array(mixed(rolling.window(at - low, size)).view(np.int64)))
                        columns += [lists(values, at[:, None] - 1 - steps), lists(values, at[:, None] + size + steps)]
                        yield pa.RecordBatch.from_arrays(columns, names)

    return asked.select("id", "key", "data", "todo").mapInArrow(work, CORE)


def window_rows(open_cores: DataFrame, width: int, k: int) -> DataFrame:
    """One row (id, key, start, a, b) per window over a core that lies in no piece.

    `a` is the hash of the core and the words left of it, `b` that of the core's rank and the words right of it; a
    window's text alone says where its core lies, so equal windows have equal pairs.
    """
    _, size, reach = side_sizes(width, k)
    columns = [kind.split()[0] for kind in WINDOW.split(", ")]

    def work(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            id_, key, at, first, n, rank, core, l, r = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "key", "at", "from", "n", "rank", "core", "l", "r"))
            left, right = (parse.prefix_hashes(batch.column(c), reach) for c in ("left", "right"))
            row = np.repeat(np.arange(len(n)), n)
            start = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + first[row]
            before = at[row] - start
            after = reach - before
            new = ~((before <= l[row]) & (after <= r[row]))
            row, start, before, after = row[new], start[new], before[new], after[new]
            a = mixed(core[row].view(np.uint64) ^ mixed(left[row, before]))
            b = mixed(rank[row].view(np.uint64) ^ mixed(right[row, after]))
            for low in range(0, len(row), 10 * ROWS):
                p = slice(low, low + 10 * ROWS)
                found = [id_[row[p]], key[row[p]], start[p], a[p].view(np.int64), b[p].view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], columns)

    return open_cores.select("id", "key", "at", "from", "n", "rank", "core", "l", "r", "left", "right").mapInArrow(work, WINDOW)


def common_words(a: str, b: str) -> Column:
    """How many words two lists share from their beginning on."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), False)
    return F.when(differs > 0, differs - 1).otherwise(F.size(a)).cast("int")


def pieces(docs: DataFrame, symbols_of, width: int, k: int) -> DataFrame:
    """(id, key, start, end, ref_id, ref_key, ref_start): stretches that a document of smaller id has as well.

    They cover all windows of `width` symbols that do. `docs` comes from `blocks.keyed`. All steps are counts and
    smallest rows by hash, combined before each shuffle, and joins of written tables, whose hot keys Spark splits.
    """
    side, size, reach = side_sizes(width, k)
    place = F.struct("id", "key", "start")
    named = blocks.run_rows(docs, symbols_of, width, k, ("id", "block"))
    two_ids = F.min("id") < F.max("id")
    index = written(named.groupBy("block").agg(two_ids.alias("shared")).where("shared").select("block"), "reference-blocks", few_files=True)
    runs = written(blocks.run_rows(docs, symbols_of, width, k).join(index, "block", "left_semi"), "runs")
    drop(index)
    # whole runs
    first = written(runs.groupBy("block", "context").agg(F.min(place).alias("first")), "first-runs", few_files=True)
    judged = runs.join(first, ["block", "context"]).withColumn("later", F.col("id") > F.col("first.id"))
    end = F.col("start") + F.col("count") + width - 1
    refs = [F.col("first.id").alias("ref_id"), F.col("first.key").alias("ref_key"), F.col("first.start").alias("ref_start")]
    equal = written(judged.where("later").select("id", "key", "start", end.alias("end"), *refs), "equal-runs")
    # cores: a window reaches over the left side of its block, or else over the right one
    n_left = F.greatest(F.lit(0), F.least(F.col("count"), F.col("place") - side + 1))
    at = F.col("start") + F.col("place")
    core = lambda name, words, at, start, n: F.struct(F.lit(name).alias("name"), words.alias("words"), at.alias("at"), start.alias("from"), n.alias("n"))
    left = core("left", F.shiftright("sides", 32), at - side, F.col("start"), n_left)
    right = core("right", F.col("sides").bitwiseAND(F.lit(2**32 - 1)), at, F.col("start") + n_left, F.col("count") - n_left)
    heads = judged.where("not later").select("id", "key", "block", "context", F.explode(F.array(left, right)).alias("c")).where("c.n > 0")
    heads = written(heads.select("id", "key", "context", "c.at", "c.from", "c.n", F.xxhash64("block", "c.name", "c.words").alias("rank")), "cores")
    drop(runs, first)
    holder = F.struct("id", "key", "at")
    held = heads.groupBy("rank").agg(F.min(holder).alias("first"), F.count("*").alias("holders"), two_ids.alias("ids"), (F.min("context") != F.max("context")).alias("contexts"))
    held = written(held.where("ids and contexts").select("rank", "first", "holders"), "reference-cores", few_files=True)
    todo = heads.join(held, "rank").select("id", "key", F.struct("at", "from", "n", "rank", "holders", (holder == F.col("first")).alias("is_ref")).alias("todo"))
    todo = written(todo.groupBy("id", "key").agg(F.collect_set("todo").alias("todo")), "open-cores", few_files=True)
    drop(heads, held)
    asked = docs.select("id", "key", "data").join(todo, ["id", "key"]).dropDuplicates(["id", "key"])
    contexts = written(context_rows(asked, symbols_of, width, k), "contexts")
    drop(todo)
    # each core grows against its first holder
    reference = contexts.where("is_ref").select("rank", F.col("id").alias("ref_id"), F.col("key").alias("ref_key"), F.col("at").alias("ref_at"), F.col("core").alias("ref_core"), F.col("left").alias("ref_left"), F.col("right").alias("ref_right"))
    same = (F.col("id") > F.col("ref_id")) & (F.col("core") == F.col("ref_core"))
    grown = contexts.join(reference, "rank").withColumns({"l": F.when(same, common_words("left", "ref_left")), "r": F.when(same, common_words("right", "ref_right"))})
    grown = grown.withColumn("long", F.coalesce(F.col("l") + F.col("r") >= reach, F.lit(False)))
    unsettled = F.col("holders") > 2
    sides = [F.when(unsettled, F.col(c)).alias(c) for c in ("left", "right")]
    bounds = [F.when(F.col("long"), F.col(c)).otherwise(-1).alias(c) for c in ("l", "r")]
    grown = written(grown.where("long or holders > 2").select("id", "key", "at", "from", "n", "rank", "core", "long", "holders", "ref_id", "ref_key", "ref_at", *bounds, *sides), "grown")
    drop(contexts)
    grown_pieces = grown.where("long").select("id", "key", (F.col("at") - F.col("l")).alias("start"), (F.col("at") + size + F.col("r")).alias("end"), "ref_id", "ref_key", (F.col("ref_at") - F.col("l")).alias("ref_start"))
    # windows across the ends of pieces
    windows = written(window_rows(grown.where(unsettled), width, k), "windows")
    first = windows.groupBy("a", "b").agg(F.min(place).alias("first"), two_ids.alias("ids")).where("ids").drop("ids")
    first = written(first, "first-windows", few_files=True)
    later = windows.join(first, ["a", "b"]).where(F.col("id") > F.col("first.id")).select("id", "key", "start", (F.col("start") + width).alias("end"), *refs)
    found = written(equal.unionAll(grown_pieces).unionAll(later), "pieces")
    drop(equal, grown, windows, first)
    return found


def factors(found: DataFrame) -> DataFrame:
    """(id, key, factors) of the documents in `pieces`: factors from left to right, each (start, length, ref_id, ref_key, ref_start).

    Pieces that follow each other on one stretch of the reference are one. Factors don't overlap and cover the
    words of all pieces; one that begins inside its piece, where the factor before ended, may be short.
    """
    kind = "array<struct<start long, length long, ref_id long, ref_key long, ref_start long>>"
    lists = found.groupBy("id", "key").agg(F.collect_list(F.struct("start", "end", *REF)).alias("pieces"))

    def work(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), parse.greedy(batch.column("pieces"))], ["id", "key", "factors"])

    return lists.mapInArrow(work, f"id long, key long, factors {kind}")
