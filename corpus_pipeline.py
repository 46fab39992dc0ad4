"""From raw documents to packed training sequences, by five of the operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm import decontaminate, jaccard, packing, quality_rules, secrets
from demandspark.llm.common import drop_since, opened, table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, boilerplate lines cut out of their texts; n_chars follows the text.

    Null, empty and short texts go. Rows that repeat a document stay or go together. See `quality_rules.cut_documents`.
    """
    return quality_rules.cut_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: five-word shingles, a Jaccard similarity of 0.8 or more.

    The smallest (doc_id, text) of a component stays, null ids last, with all rows that repeat it; texts without words
    are linked with nothing and stay. See `jaccard.one_of_each`.
    """
    return jaccard.one_of_each(docs, 5, 80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item.

    Null and empty texts have no windows and stay, rows that repeat a document stay or go together; without benchmark
    items all rows stay. See `decontaminate.contamination`.
    """
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked; n_chars follows the text.

    Null and empty texts stay as they are, every row keeps its row, and other columns pass, whatever their names.
    """
    others = F.struct(*[docs[c] for c in docs.columns if c != "text"])
    found = secrets.scan_paths(docs.select(others.alias("others"), docs["text"]), ["others"])
    changed = F.size("spans") > 0
    masked = found.select("others", changed.alias("changed"), secrets.masked(F.col("text"), F.col("spans")).alias("text"))

    def column(name: str):
        if name == "text":
            return F.col("text")
        own = F.col("others").getField(name)
        if name == "n_chars":
            own = F.when(F.col("changed"), F.char_length("text").cast(docs.schema[name].dataType)).otherwise(own)
        return own.alias(name)

    return masked.select(*map(column, docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece's place in sequences of 2048 tokens.

    Null and empty texts are one piece, the closing id alone; rows that repeat an id or a text are packed each for
    itself; no documents give no rows. See `packing.pack_documents`.
    """
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

# the tokenizer cannot be stated in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written before the next one reads it, and its input and scratch tables then dropped."""
    docs = table(spark, sf_dir, "documents")
    before = opened()
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        drop_since(before, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
