"""Prefix doubling over the byte positions of all texts at which a string of `width` bytes may repeat.

A filter comes first, since a row per byte would outgrow the disk: `blocks` picks a block for each string, and blocks,
whole runs around them, and cores (a block with the bytes on one side) that no other place has are dropped. A core
with two holders is settled by comparing the bytes around both.

The positions that are left are ranked by their first `width / 2^r` bytes. Each round pairs the rank of a position with
the rank that the position as many bytes further on has, sorts the pairs together, and reranks; positions whose
pair is unique drop out, and the length doubles until it has reached `width`. Ranks are 64-bit fingerprints of their
strings, so the rank further on is computed from the bytes and needs no join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks, stretches
from .common import drop, written

register_pickle_by_value(stretches)

ROWS = 1500  # stretches laid out at once
CORE = "id long, key long, at long, from long, n int, rank long, holders long, is_ref boolean, before int, stretch binary"
GROWN = "id long, key long, at long, from long, n int, before int, stretch binary, l int, r int, holders long"


def first_length(width: int) -> tuple[int, int]:
    """(length, rounds): `width` halved as long as it is even and above 25."""
    rounds = 0
    while width % 2 == 0 and width > 25:
        width, rounds = width // 2, rounds + 1
    return width, rounds


def context_rows(asked: DataFrame, reach: int, size: int) -> DataFrame:
    """The bytes of each core asked for with up to `reach` more on both sides; `asked` has id, key, data and todo."""
    kinds = {c.split()[0]: c.split()[1] for c in CORE.split(", ")}
    types = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}

    def work(batches):
        for batch in batches:
            for id_, key, data, todo in zip(*(batch.column(c).to_pylist() for c in ("id", "key", "data", "todo"))):
                for low in range(0, len(todo), 10 * ROWS):
                    some = todo[low : low + 10 * ROWS]
                    found = {c: [t[c] for t in some] for c in ("at", "from", "n", "rank", "holders", "is_ref")}
                    found |= {"id": [id_] * len(some), "key": [key] * len(some), "before": [min(reach, t["at"]) for t in some]}
                    found["stretch"] = [data[max(0, t["at"] - reach) : t["at"] + size + reach] for t in some]
                    yield pa.RecordBatch.from_arrays([pa.array(found[c], types[kind]) for c, kind in kinds.items()], list(kinds))

    return asked.select("id", "key", "data", "todo").mapInArrow(work, CORE)


def grown(pairs: DataFrame, reach: int, size: int) -> DataFrame:
    """Each context with the bytes l and r that it shares with its reference before and after the core (-1: other cores)."""

    def lines(batch, stretch, before):
        return stretches.laid_out(batch.column(stretch).to_pylist(), batch.column(before).to_numpy(), reach, size)

    def work(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, ROWS):
                batch = whole.slice(low, ROWS)
                l, r = stretches.agreement(lines(batch, "stretch", "before"), lines(batch, "ref_stretch", "ref_before"), reach, size)
                own = [batch.column(c) for c in ("id", "key", "at", "from", "n", "before", "stretch")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(l.astype(np.int32)), pa.array(r.astype(np.int32)), batch.column("holders")], [c.split()[0] for c in GROWN.split(", ")])

    return pairs.select("id", "key", "at", "from", "n", "before", "stretch", "ref_before", "ref_stretch", "holders").mapInArrow(work, GROWN)


def position_rows(contexts: DataFrame, width: int, reach: int, size: int) -> DataFrame:
    """(id, key, start, names) of the strings over a core that lie in no settled stretch; names of their equal parts."""
    length, rounds = first_length(width)

    def work(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, ROWS):
                batch = whole.slice(low, ROWS)
                id_, key, at, first, n, before, l, r = (batch.column(c).to_numpy().astype(np.int64) for c in ("id", "key", "at", "from", "n", "before", "l", "r"))
                lines, _ = stretches.laid_out(batch.column("stretch").to_pylist(), before, reach, size)
                row = np.repeat(np.arange(len(n)), n)
                start = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + first[row]
                left = at[row] - start
                new = ~((left <= l[row]) & (width - size - left <= r[row]))
                row, start, left = row[new], start[new], left[new]
                named = stretches.names(lines, row, reach - left, length, 2**rounds)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(np.stack(named, 1).reshape(-1)), 2**rounds).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(id_[row]), pa.array(key[row]), pa.array(start), flat], ["id", "key", "start", "names"])

    return contexts.mapInArrow(work, "id long, key long, start long, names array<long>")


def doubled(positions: DataFrame, width: int) -> DataFrame:
    """Rounds of doubling: (id, key, start) of each position whose `width` bytes also stand at an earlier one."""
    _, rounds = first_length(width)
    place = F.struct("id", "key", "start")
    ranked = positions.withColumn("rank", F.col("names")[0])
    for k in range(max(1, rounds)):
        # the rank as many bytes further on, from the names of the parts there; none where the width does not halve
        further = F.xxhash64(*[F.col("names")[j] for j in range(2**k, 2 ** (k + 1))]) if rounds else F.lit(0)
        pairs = ranked.withColumn("further", further)
        last = k >= rounds - 1
        held = pairs.groupBy("rank", "further").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
        held = written(held.select("rank", "further", *(["first"] if last else [])), "ranks", few_files=True)
        if last:
            found = written(pairs.join(held, ["rank", "further"]).where(place > F.col("first")).select("id", "key", "start"), "repeated")
        else:
            kept = pairs.join(held, ["rank", "further"], "left_semi")
            found = written(kept.select("id", "key", "start", "names", F.xxhash64("rank", "further").alias("rank")), "ranked")
        drop(held)
        if k:
            drop(ranked)
        ranked = found
    return ranked


def repeated(docs: DataFrame, symbols_of, width: int, k: int) -> DataFrame:
    """(id, key, spans): stretches of bytes made of strings that also start earlier, by id, key and start.

    `docs` comes from `blocks.keyed`. All of it is counts and smallest rows by hash, combined before each shuffle,
    and joins of written tables, whose hot keys Spark splits.
    """
    side = (width - k) // 2
    size, reach = k + side, width - k - side
    place = F.struct("id", "key", "start")
    named = blocks.run_rows(docs, symbols_of, width, k, ("id", "block"))
    shared = written(named.groupBy("block").agg((F.count("*") > 1).alias("twice")).where("twice").select("block"), "shared-blocks", few_files=True)
    runs = written(blocks.run_rows(docs, symbols_of, width, k).join(shared, "block", "left_semi"), "runs")
    drop(shared)
    first = written(runs.groupBy("block", "context").agg(F.min(place).alias("first")), "first-runs", few_files=True)
    judged = runs.join(first, ["block", "context"]).withColumn("later", place > F.col("first"))
    equal = judged.where("later").select("id", "key", "start", (F.col("start") + F.col("count") + width - 1).alias("end"))
    equal = written(equal, "equal-runs")
    # cores: a string reaches over the left side of its block, or else over the right one
    n_left = F.greatest(F.lit(0), F.least(F.col("count"), F.col("place") - side + 1))
    at = F.col("start") + F.col("place")
    core = lambda name, words, at, start, n: F.struct(F.lit(name).alias("name"), words.alias("words"), at.alias("at"), start.alias("from"), n.alias("n"))
    left = core("left", F.shiftright("sides", 32), at - side, F.col("start"), n_left)
    right = core("right", F.col("sides").bitwiseAND(F.lit(2**32 - 1)), at, F.col("start") + n_left, F.col("count") - n_left)
    heads = judged.where("not later").select("id", "key", "block", "context", F.explode(F.array(left, right)).alias("c")).where("c.n > 0")
    heads = written(heads.select("id", "key", "context", "c.at", "c.from", "c.n", F.xxhash64("block", "c.name", "c.words").alias("rank")), "cores")
    drop(runs, first)
    holder = F.struct("id", "key", "at")
    held = heads.groupBy("rank").agg(F.min(holder).alias("first"), F.count("*").alias("holders"), (F.min("context") != F.max("context")).alias("differ"))
    held = written(held.where("differ").select("rank", "first", "holders"), "repeated-cores", few_files=True)
    todo = heads.join(held, "rank").select("id", "key", F.struct("at", "from", "n", "rank", "holders", (holder == F.col("first")).alias("is_ref")).alias("todo"))
    todo = written(todo.groupBy("id", "key").agg(F.collect_set("todo").alias("todo")), "open-cores", few_files=True)
    drop(heads, held)
    asked = docs.select("id", "key", "data").join(todo, ["id", "key"]).dropDuplicates(["id", "key"])
    contexts = written(context_rows(asked, reach, size), "contexts")
    drop(todo)
    # the first holder of a core is compared with all others
    reference = contexts.where("is_ref").select("rank", F.col("before").alias("ref_before"), F.col("stretch").alias("ref_stretch"))
    others = grown(contexts.where("not is_ref").join(reference, "rank"), reach, size)
    firsts = contexts.where("is_ref and holders > 2").select(*[F.lit(-1).alias(c) if c in "lr" else F.col(c) for c in (g.split()[0] for g in GROWN.split(", "))])
    enough = F.col("l") + F.col("r") >= reach
    compared = written(others.where(enough | (F.col("holders") > 2)).unionAll(firsts), "compared")
    drop(contexts)
    settled = compared.where(enough).select("id", "key", (F.col("at") - F.col("l")).alias("start"), (F.col("at") + size + F.col("r")).alias("end"))
    limit = lambda c: F.when(enough, F.col(c)).otherwise(-1).alias(c)
    unsettled = compared.where("holders > 2").select("id", "key", "at", "from", "n", "before", "stretch", limit("l"), limit("r"))
    positions = written(position_rows(unsettled, width, reach, size), "positions")
    later = doubled(positions, width)
    drop(positions)
    found = equal.unionAll(settled).unionAll(later.select("id", "key", "start", (F.col("start") + width).alias("end")))
    spans = written(found.groupBy("id", "key").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans", few_files=True)
    drop(equal, compared, later)
    return spans
