"""Quality rules: text statistics, and lines that many documents of a host share.

Lines are normalised and hashed. Distinct documents are counted by host and line; a line that stands in more of them than
the limits allow is a candidate. Copies must not count as documents of their own: equal texts are one document, and a
document that has less than `MIN_LEFT` per cent of its words outside of candidate lines doesn't count, as it may be one of
a family of near copies, of which all lines are candidates. Candidates that are still over the limits by the documents
with words of their own are boilerplate. Boilerplate lines are removed; a document with too few words left is rejected,
besides those that fail a base rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_WORD, drop, extract_all, only, text_key, whole, written

SPACE = r"\x20\x09-\x0D"
WINDOW = 8
MIN_WORDS, MAX_REPEATED = 20, 30
MIN_DOCS, HOST_SHARE, MIN_LEFT = 10, 0.005, 20


def line_hash(line):
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(line, f"[{SPACE}]+", " "))))


def worded_lines(text):
    r"""The \n-split lines that have a word."""
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(f"[^{SPACE}]"))


def statistics(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row per row of `docs`: doc_id, text_key, host and the base counts, all from the row itself."""
    rows = docs.select("doc_id", text_key().alias("text_key"), F.col(host).alias("host"), whole().alias("t"))
    words = rows.select("doc_id", "text_key", "host", "t", extract_all(F.col("t"), SPACE_WORD).alias("w"), worded_lines(F.col("t")).alias("lines"))
    hashes = F.transform(F.sequence(F.lit(0), F.size("w") - WINDOW), lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(WINDOW)]))
    counted = words.select(
        "doc_id",
        "text_key",
        "host",
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size(extract_all(F.col("t"), r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("w") > WINDOW, hashes).otherwise(F.array().cast("array<bigint>")).alias("h"),
    )
    # only texts with an equal pair of windows sort them
    order = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    ordered = counted.withColumn("s", F.when(F.size(F.array_distinct("h")) < F.size("h"), order))
    same = lambda e, k: F.coalesce(F.get("s", k)["x"] == e["x"], F.lit(False))
    twice = F.sort_array(F.transform(F.filter("s", lambda e, k: F.when(k > 0, same(e, k - 1)).otherwise(False) | same(e, k + 1)), lambda e: e["i"]))
    starts = ordered.withColumn("at", F.when(F.col("s").isNotNull(), twice).otherwise(F.array().cast("array<int>")))
    covered = F.aggregate(
        "at",
        F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct((p + WINDOW).alias("upto"), (a["n"] + p + WINDOW - F.greatest(a["upto"], p)).alias("n")),
        lambda a: a["n"],
    )
    base = starts.withColumn("n_repeat_words", covered).drop("h", "s", "at")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return base.withColumn("base_failed", failed)


def over_limit(counts: DataFrame, count: str, min_docs: int, host_share: float) -> DataFrame:
    return counts.where((F.col(count) > min_docs) & (F.col(count) > host_share * F.col("total")))


def common_lines(docs: DataFrame, host: str, min_docs: int, host_share: float) -> DataFrame:
    """(host, line, n_docs, total) of lines in more different texts of a host than the limits allow; written."""
    rows = docs.select(F.col(host).alias("host"), text_key().alias("text_key"), F.array_distinct(F.transform(worded_lines(whole()), line_hash)).alias("lines"))
    counts = rows.select("host", "text_key", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count_distinct("text_key").alias("n_docs"))
    over = written(counts.where(F.col("n_docs") > min_docs), "shared-lines", few_files=True)
    hosts = written(docs.groupBy(F.col(host).alias("_host")).agg(F.count("*").alias("total")), "hosts", few_files=True)
    joined = over.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    common = written(over_limit(joined, "n_docs", min_docs, host_share), "common-lines", few_files=True)
    drop(over, hosts)
    return common


def holders(docs: DataFrame, host: str, lines: DataFrame) -> DataFrame:
    """(doc_id, text_key, host, held) of documents that have any of the given (host, line); `held` is a set of (place, line, words)."""
    rows = docs.select("doc_id", text_key().alias("text_key"), F.col(host).alias("host"), F.posexplode(worded_lines(whole())).alias("place", "text_line"))
    each = rows.select("doc_id", "text_key", "host", "place", line_hash(F.col("text_line")).alias("line"), F.size(extract_all(F.col("text_line"), SPACE_WORD)).alias("words"))
    side = lines.select(F.col("host").alias("_host"), F.col("line").alias("_line"))
    met = each.join(side, (F.col("line") == F.col("_line")) & F.col("host").eqNullSafe(F.col("_host")))
    # a set, so that rows repeating a document do not count its lines again
    return met.groupBy("doc_id", "text_key", "host").agg(F.collect_set(F.struct("place", "line", "words")).alias("held"))


def words_in(lines: str):
    return F.aggregate(lines, F.lit(0).cast("long"), lambda a, g: a + g["words"])


def enough_left(lost, min_left: int):
    return 100 * (F.col("n_words") - lost) >= min_left * F.col("n_words")


def same_document(left: str, right: str):
    pairs = [F.col(f"{left}{c}").eqNullSafe(F.col(f"{right}{c}")) for c in ("doc_id", "host")]
    return pairs[0] & (F.col(f"{left}text_key") == F.col(f"{right}text_key")) & pairs[1]


def renamed(table: DataFrame, *more: str) -> DataFrame:
    return table.select(*(F.col(c).alias(f"_{c}") for c in ("doc_id", "text_key", "host")), *more)


def counted_lines(found: DataFrame, base: DataFrame, common: DataFrame, min_docs: int, host_share: float, min_left: int) -> DataFrame:
    """(host, line, n_docs, n_own) of the `common` lines that `n_own` texts with words of their own have, over the limits."""
    sized = found.join(renamed(base, "n_words").distinct(), same_document("", "_"))
    own = sized.where(enough_left(words_in("held"), min_left)).select("host", "text_key", F.explode(F.array_distinct(F.transform("held", lambda g: g["line"]))).alias("line"))
    counts = own.groupBy("host", "line").agg(F.count_distinct("text_key").alias("n_own"))
    totals = common.select(F.col("host").alias("_host"), F.col("line").alias("_line"), "n_docs", "total")
    joined = counts.join(totals, (F.col("line") == F.col("_line")) & F.col("host").eqNullSafe(F.col("_host")))
    return over_limit(joined, "n_own", min_docs, host_share).select("host", "line", "n_docs", "n_own")


def boilerplate(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, host_share: float = HOST_SHARE, min_left: int = MIN_LEFT) -> DataFrame:
    """(host, line, n_docs, n_own): lines in more documents of a host than `min_docs` and `host_share` of its documents.

    `n_docs` counts all different texts with the line, `n_own` those with `min_left` per cent of their words outside of
    lines that pass the limits by `n_docs`; it decides. Null and empty texts have no lines; a null host is a host.
    """
    common = common_lines(docs, host, min_docs, host_share)
    found = written(holders(docs, host, common), "line-holders", few_files=True)
    return counted_lines(found, statistics(docs, host), common, min_docs, host_share, min_left)


def judge(docs: DataFrame, host: str = "source", min_left: int = MIN_LEFT) -> DataFrame:
    """One row per (doc_id, text, host): the statistics, n_boilerplate_words, removed line hashes, kept.

    `kept` is false where the base rules fail or boilerplate leaves less than `min_left` per cent of the words. Null and
    empty texts have no words, so they fail. A null host is a host of its own. Rows that repeat a doc_id, text and host
    get one row each. An empty table gives an empty result. Columns other than doc_id, text and the host are not read.
    Line and window equality is that of 64-bit hashes.

    Text never leaves its row: line hashes and counts are what is shuffled.
    """
    # written: a caller's filter on the counts must not be pushed below, into the work on words
    base = written(statistics(docs, host), "statistics")
    common = common_lines(docs, host, MIN_DOCS, HOST_SHARE)
    found = written(holders(docs, host, common), "line-holders", few_files=True)
    shared = written(counted_lines(found, base, common, MIN_DOCS, HOST_SHARE, min_left), "boilerplate", few_files=True)
    side = shared.select(F.col("host").alias("_host"), F.col("line").alias("_line"))
    hits = found.select("doc_id", "text_key", "host", F.inline("held")).join(side, (F.col("line") == F.col("_line")) & F.col("host").eqNullSafe(F.col("_host")))
    lost = hits.groupBy("doc_id", "text_key", "host").agg(F.collect_set(F.struct("place", "line", "words")).alias("gone"))
    lost = written(renamed(lost, "gone"), "lost-lines", few_files=True)
    drop(common, found, shared)
    judged = (
        base.join(lost, same_document("", "_"), "left")
        .withColumn("n_boilerplate_words", F.coalesce(words_in("gone"), F.lit(0).cast("long")))
        .withColumn("removed_lines", F.coalesce(F.array_distinct(F.transform("gone", lambda g: g["line"])), F.array().cast("array<bigint>")))
        .withColumn("kept", ~F.col("base_failed") & enough_left(F.col("n_boilerplate_words"), min_left))
        .drop("_doc_id", "_text_key", "_host", "gone")
    )
    judged.scratch = [base, lost]
    return judged


def kept_documents(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows of `docs` that pass, all their columns as they were; a text that passes under any host stays under all."""
    return only(docs, judge(docs, host).where("kept").select("doc_id", "text_key").distinct())


def without_boilerplate(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows that pass as (doc_id, text), boilerplate lines cut out of the text."""
    return cut_documents(docs, host).select("doc_id", "text")


def cut_documents(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows that pass with all their columns, boilerplate lines cut out of the text; n_chars follows a cut text.

    Null, empty and wordless texts fail and go, also where the id is null. Rows that repeat a document stay or go
    together, and a text is cut by the lines of its own host. An empty table gives no rows. Only what was decided is
    kept on disk beside `docs`.
    """
    judged = judge(docs, host)
    kept = written(renamed(judged.where("kept"), F.col("removed_lines").alias("_gone")).dropDuplicates(["_doc_id", "_text_key", "_host"]), "kept-documents", few_files=True)
    drop(*judged.scratch)
    others = F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("others")
    rows = docs.select(others, "text", "doc_id", text_key().alias("text_key"), F.col(host).alias("host"))
    left = F.filter(F.split("text", "\n", -1), lambda line: ~F.array_contains("_gone", line_hash(line)))
    changed = F.size("_gone") > 0
    cut = rows.join(kept, same_document("", "_")).select("others", changed.alias("changed"), F.when(changed, F.array_join(left, "\n")).otherwise(F.col("text")).alias("text"))

    def column(name: str):
        if name == "text":
            return F.col("text")
        own = F.col("others").getField(name)
        if name == "n_chars":
            own = F.when(F.col("changed"), F.char_length("text").cast(docs.schema[name].dataType)).otherwise(own)
        return own.alias(name)

    return cut.select(*map(column, docs.columns))
