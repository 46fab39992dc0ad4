"""Benchmark decontamination: a broadcast hash set of normalised item n-grams, scanned by every training window.

Documents become words in one pass; each position's window of words is hashed inside generated code and looked up
in the broadcast set. A hit is verified by comparing the words themselves. Spans of hit words, or whole documents,
can then be removed. Only hits and one row per document are shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, extract_all, only, text_key, whole

N = 10
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UNIT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*" + WORD_ANY_CASE
BROADCAST_WINDOWS = 200_000


def window_hash(words: str, at: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(F.col(words), at + F.lit(k)) for k in range(length)])


def windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """(window words, length, hash, items): every n consecutive words of an item, or all of an item with fewer."""
    words = benchmark.select("item_id", extract_all(ascii_lower(whole()), WORD).alias("w"))
    starts = F.when(F.size("w") >= n, F.sequence(F.lit(0), F.size("w") - n)).when(F.size("w") > 0, F.array(F.lit(0)))
    each = words.withColumn("at", F.explode(starts)).select("item_id", F.slice("w", F.col("at") + 1, n).alias("win"))
    hashed = F.coalesce(*[F.when(F.size("win") == k, window_hash("win", F.lit(0), k)) for k in range(1, n + 1)])
    return each.groupBy("win").agg(F.collect_set("item_id").alias("items")).select("win", F.size("win").alias("len"), hashed.alias("hash"), "items")


def scan(docs: DataFrame, known: DataFrame, lengths: list[int], blocks: int) -> DataFrame:
    """One row per document (its position 0) and one per verified hit: n_words, at, len, items."""
    words = docs.select("doc_id", text_key().alias("text_key"), extract_all(ascii_lower(whole()), WORD).alias("w"))
    spread = words.select("doc_id", "text_key", "w", F.posexplode_outer("w").alias("at", "word")).withColumn("at", F.coalesce("at", F.lit(0)))
    if len(lengths) == 1:
        keyed = spread.withColumn("n", F.lit(lengths[0])).withColumn("h", window_hash("w", F.col("at"), lengths[0]))
    else:
        each = F.array(*[F.struct(F.lit(k).alias("n"), window_hash("w", F.col("at"), k).alias("h")) for k in lengths])
        keyed = spread.withColumn("key", F.explode(each)).select("doc_id", "text_key", "w", "at", "key.n", "key.h")

    def against(block: int) -> DataFrame:
        part = known if blocks == 1 else known.where(F.pmod("hash", F.lit(blocks)) == block)
        # the join key is the hash alone, a plain long; the words are compared only where it meets
        met = keyed.join(F.broadcast(part), F.col("h") == F.col("hash"), "left")
        verified = F.coalesce(F.slice("w", F.col("at") + 1, F.col("n")) == F.col("win"), F.lit(False))
        first = (F.col("at") == 0) & (F.lit(block) == 0)
        return met.where(first | verified).select(
            "doc_id", "text_key", F.size("w").cast("long").alias("n_words"), "at", "len", F.when(verified, F.col("items")).alias("items")
        )

    return reduce(DataFrame.unionAll, map(against, range(blocks)))


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """One row per (doc_id, text): n_words, n_hit, item_ids (sorted, as strings), spans of hit words, contaminated.

    `spans` holds maximal runs as (start, end), in words, end exclusive. Null and empty texts have no words and no
    hits; items without words are ignored; an empty benchmark hits nothing. Rows that repeat a doc_id and text are
    one row, a doc_id with two texts has two; null ids are kept as they are. Items with a null id hit words but
    are not listed. Other columns are not read.

    The set is broadcast in blocks of `BROADCAST_WINDOWS` windows at most, each with a scan of its own, so a larger
    benchmark costs scans, not memory. Hits of a document are gathered in one row; there are no more than its words.
    """
    known = windows(benchmark, n)
    sizes = {r["len"]: r["count"] for r in known.groupBy("len").count().collect()}
    blocks = max(1, -(-sum(sizes.values()) // BROADCAST_WINDOWS))
    rows = scan(docs, known, sorted(sizes) or [n], blocks)
    hit = F.col("items").isNotNull()
    per_doc = rows.groupBy("doc_id", "text_key").agg(
        F.max("n_words").alias("n_words"),
        F.collect_list(F.when(hit, F.struct("at", (F.col("at") + F.col("len")).alias("end")))).alias("hits"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    # hits in order of start; a run goes on while the next hit starts inside it or right at its end
    merged = F.aggregate(
        F.sort_array("hits"),
        F.struct(F.array().cast("array<struct<start:int,end:int>>").alias("done"), F.lit(0).alias("start"), F.lit(-1).alias("end")),
        lambda a, s: F.when(s["at"] <= a["end"], F.struct(a["done"].alias("done"), a["start"].alias("start"), F.greatest(a["end"], s["end"]).alias("end"))).otherwise(
            F.struct(F.when(a["end"] > 0, F.array_append(a["done"], F.struct(a["start"].alias("start"), a["end"].alias("end")))).otherwise(a["done"]).alias("done"), s["at"].alias("start"), s["end"].alias("end"))
        ),
        lambda a: F.when(a["end"] > 0, F.array_append(a["done"], F.struct(a["start"].alias("start"), a["end"].alias("end")))).otherwise(a["done"]),
    )
    spans = per_doc.withColumn("spans", merged)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return spans.select(
        "doc_id",
        "text_key",
        "n_words",
        n_hit.alias("n_hit"),
        F.array_sort(F.transform("items", lambda i: i.cast("string"))).alias("item_ids"),
        "spans",
    ).withColumn("contaminated", F.col("n_hit") > 0)


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """The rows of `docs` without any hit, all their columns as they were."""
    return only(docs, contamination(docs, benchmark, n).where(~F.col("contaminated")))


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """All rows as (doc_id, text), the hit words cut out with the separators before them."""
    found = contamination(docs, benchmark, n).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "spans", "n_words")
    joined = docs.select("doc_id", "text").join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (text_key() == F.col("_key")), "left")
    starts = F.concat(F.array(F.lit(0)), F.transform("spans", lambda s: s["end"]))
    ends = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.col("n_words").cast("int")))
    units = extract_all(F.col("text"), UNIT)
    kept = F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(units, a + 1, b - a)))
    return joined.select("doc_id", F.when(F.size("spans") > 0, F.array_join(kept, "")).otherwise(F.col("text")).alias("text"))
