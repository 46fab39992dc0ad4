"""Secret scans over an incremental blob ledger.

Every version of every file is addressed by the SHA-256 of its content. The ledger is a folder with two tables:
`pairs` (blob, rule, version) holds what has been scanned, `findings` what was found. A scan takes the distinct
blobs, drops the pairs of blob and rule version that the ledger has, runs the rules that are left for a blob, adds
to the ledger, and joins the findings back to all paths. The files of an earlier scan cost a hash, not a scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import CLEANUP, exists, fresh_path, whole, written


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of `pattern`; the given group must have `least` characters.

    A text without a match of `gate` has no finding of this rule; it only spares work, and without one it is `pattern`.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    version: int = 1
    gate: str | None = None


# fixed values
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, gate=r"(?i:password|passwd|secret|token|api_?key)[\x20\"':=]"),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, gate=r"AKIA[A-Z0-9]{16}"),
    Rule("hex", r"[0-9a-f]+", 0, 24, gate=r"[0-9a-f]{24}"),
)
ADDED = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40, gate=r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", gate=r"-----BEGIN "),
)
RULES = BASE + ADDED
PAIRS = "blob string, rule string, version int"
FINDINGS = PAIRS + ", start int, end int"


def blob(text):
    """The content address."""
    return F.sha2(text.cast("binary"), 256)


def read_ledger(spark: SparkSession, ledger: str, name: str, schema: str) -> DataFrame:
    """A ledger table, empty before the first scan."""
    path = f"{ledger}/{name}"
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def unseen(versions: DataFrame, ledger: str, rules) -> DataFrame:
    """Distinct blobs (blob, text, todo) whose `todo` names at least one rule that the ledger has not seen for it."""
    spark = versions.sparkSession
    blobs = versions.select(blob(whole()).alias("blob"), whole().alias("text")).dropDuplicates(["blob"])
    wanted = F.array(*[F.lit(f"{r.kind}:{r.version}") for r in rules])
    seen = read_ledger(spark, ledger, "pairs", PAIRS)
    if seen.isEmpty():
        return blobs.withColumn("todo", wanted)
    done = seen.groupBy(F.col("blob").alias("_blob")).agg(F.collect_set(F.concat_ws(":", "rule", "version")).alias("done"))
    joined = blobs.join(done, F.col("blob") == F.col("_blob"), "left")
    todo = F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>")))
    return joined.select("blob", "text", todo.alias("todo")).where(F.size("todo") > 0)


def find(blobs: DataFrame, rules) -> DataFrame:
    """(blob, rule, version, start, end) of every match that passes, in code points."""

    def matches(rule: Rule):
        wanted = F.array_contains("todo", f"{rule.kind}:{rule.version}") & F.col("text").rlike(rule.gate or rule.pattern)
        found = F.arrays_zip(F.split("text", rule.pattern, -1).alias("gap"), F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0)).alias("hit"))
        return F.struct(F.lit(rule.kind).alias("rule"), F.lit(rule.version).alias("version"), F.when(wanted, found).alias("found"))

    each = blobs.select("blob", F.inline(F.array(*map(matches, rules)))).where("size(found) > 1")
    rows = each.select("blob", "rule", "version", F.posexplode("found").alias("i", "part")).select("blob", "rule", "version", "i", "part.gap", "part.hit")
    before = W.partitionBy("blob", "rule", "version").orderBy("i")
    ends = F.sum(F.char_length("gap") + F.coalesce(F.char_length("hit"), F.lit(0))).over(before)
    passes = F.lit(False)
    for rule in rules:
        value = F.regexp_extract("hit", rule.pattern, rule.group)
        passes = passes | ((F.col("rule") == rule.kind) & (F.col("version") == rule.version) & (F.char_length(value) >= rule.least))
    placed = rows.withColumn("end", ends.cast("int")).where(F.col("hit").isNotNull() & passes)
    return placed.select("blob", "rule", "version", (F.col("end") - F.char_length("hit")).alias("start"), "end")


def scan(versions: DataFrame, ledger: str, rules=RULES) -> DataFrame:
    """Scan what the ledger has not seen; return the ledger's findings for these rule versions.

    Findings are written before the pairs that vouch for them: a scan that breaks off is repeated in whole by the
    next one, and what it wrote twice is read once.
    """
    spark = versions.sparkSession
    todo = unseen(versions, ledger, rules)
    cleanup = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        find(todo, rules).write.mode("append").parquet(f"{ledger}/findings")
        if not read_ledger(spark, ledger, "pairs", PAIRS).isEmpty():
            todo = unseen(versions.select("text"), ledger, rules)
        else:
            wanted = F.array(*[F.lit(f"{r.kind}:{r.version}") for r in rules])
            todo = versions.select(blob(whole()).alias("blob")).distinct().withColumn("todo", wanted)
        pair = F.split("pair", ":")
        pairs = todo.select("blob", F.explode("todo").alias("pair")).select("blob", pair[0].alias("rule"), pair[1].cast("int").alias("version"))
        pairs.write.mode("append").parquet(f"{ledger}/pairs")
    finally:
        spark.conf.set(CLEANUP, cleanup)
    current = F.concat_ws(":", "rule", "version").isin([f"{r.kind}:{r.version}" for r in rules])
    return read_ledger(spark, ledger, "findings", FINDINGS).where(current).distinct()


def spans_by_blob(findings: DataFrame, rules=RULES) -> DataFrame:
    """(blob, spans): per blob its findings as (start, place of the rule, kind, end), in that order; written."""
    place = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("rule"))
    span = F.struct("start", place.cast("int").alias("place"), F.col("rule").alias("kind"), "end")
    return findings.groupBy("blob").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def scan_paths(versions: DataFrame, paths: list[str], ledger: str | None = None, rules=RULES) -> DataFrame:
    """One row per row of `versions`: its `paths` columns, blob, text and spans (start, place, kind, end).

    Positions are code points, ends exclusive; spans are ordered by start, then by the rules' order, and may overlap
    between kinds. Null texts are empty ones. Rows that repeat a path or a text each keep their row; equal texts are
    scanned once. An empty table gives no rows. Columns other than `paths` and `text` are not read. Without a
    `ledger` folder a fresh one in the shared folder is used, so all blobs are unseen.

    Blobs with findings are written as a table of their own before the join with all paths, so that the join shuffles
    both sides itself and Spark splits a blob that a third of all paths hold.
    """
    spark = versions.sparkSession
    ledger = ledger or fresh_path(spark, "ledger")
    found = written(spans_by_blob(scan(versions.select("text"), ledger, rules), rules), "secret-spans")
    addressed = versions.select(*paths, "text", blob(whole()).alias("blob"))
    side = found.select(F.col("blob").alias("_blob"), F.col("spans").alias("_spans"))
    joined = addressed.join(side, F.col("blob") == F.col("_blob"), "left")
    none = F.array().cast(found.schema["spans"].dataType)
    return joined.select(*paths, "blob", "text", F.coalesce("_spans", none).alias("spans"))


def masked(text, spans, mask: str = "[secret]"):
    """The text with every maximal run of overlapping spans replaced."""
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("upto"))
    done = F.aggregate(
        ordered,
        state,
        lambda a, s: F.struct(
            F.when(s["start"] >= a["upto"], F.concat(a["out"], F.substring(text, a["upto"] + 1, s["start"] - a["upto"]), F.lit(mask))).otherwise(a["out"]).alias("out"),
            F.greatest(a["upto"], s["end"]).alias("upto"),
        ),
    )
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(done["out"], F.substring(text, done["upto"] + 1, F.char_length(text))))
