"""The registered queries of the operators, over whole tables, and the SQL for those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import classifier, decontaminate, jaccard, lexical, oracle, packing, quality_rules, resampling, rlz_dedup, secrets, sharding, simhash, suffix_dedup, url_filter
from .common import table, whole

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register under the function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def sha(text):
    return F.sha2(text, 256)


@query(oracle.SECRETS)
def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document, found by a scan of its blob against an empty ledger."""
    found = secrets.scan_paths(table(spark, folder, "documents"), ["doc_id"])
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in secrets.BASE]))
    return found.select(
        "doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        sha(joined(base)).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@query(oracle.DECONTAMINATE)
def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside a 10-word window of a benchmark item."""
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        sha(F.array_join("item_ids", ",")).alias("items_sha256"),
        "contaminated",
    )


@query(oracle.QUALITY)
def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base statistics and the verdict on every document; its host is its source."""
    judged = quality_rules.judge(table(spark, folder, "documents"), "source")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_boilerplate_words")


@query(oracle.URLS)
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The rule and verdict for every page's url."""
    return url_filter.filter_urls(table(spark, folder, "pages"))


@query()
def op7_shard(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's shard and slot; shard sizes in rows are at most one apart."""
    text = whole()
    sized = table(spark, folder, "documents").select(
        "doc_id",
        "text",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = sharding.shard(sized)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query()
def op10_pack(spark: SparkSession, folder: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens."""
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query(oracle.SUFFIXES)
def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every document in a 100-byte string that also starts earlier."""
    cut = suffix_dedup.deduplicate(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", sha(F.col("kept")).alias("kept_sha256"))


@query(oracle.WORD_WINDOWS)
def op6_rlz_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document in a 50-word window that also starts in a document of smaller id."""
    cut = rlz_dedup.deduplicate(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", sha(F.col("text")).alias("kept_sha256"))


@query(oracle.JACCARD)
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """The component of every document under links of at least 0.9 on 3-word shingles."""
    return jaccard.near_duplicates(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@query()
def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """The quality score of every document by a model of the labels that are not held out."""
    docs = table(spark, folder, "documents")
    model = classifier.train(docs, table(spark, folder, "labels"))
    held = classifier.held_out(F.col("doc_id")).alias("held_out")
    return classifier.score(docs, model).select("doc_id", held, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query(oracle.RESAMPLE)
def op11_importance_resample(spark: SparkSession, folder: str) -> DataFrame:
    """Weight, score and rank in the draw of every document, towards the benchmark's word runs."""
    drawn = resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query(oracle.SEARCH)
def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op13_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The fingerprint and the component of every document; fingerprints link at four differing bits or fewer."""
    return simhash.near_duplicates(table(spark, folder, "documents"))
