"""URL filters by host-suffix and path-prefix expressions, looked up by short digest prefixes.

A rule is a host and a path, written `host/path`. It fits its host and all subdomains, where the url's path
starts with the rule's path. Every url is expanded into all suffixes of its host, each with those prefixes of its
path whose length some rule has. Expressions meet rules in an equi-join on the first 32 bits of their SHA-256;
the full digest then confirms the pair. The longest fitting rule decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UPPER, LOWER

# fixed values
RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]
BROADCAST_RULES = 100_000


def digest(text):
    return F.sha2(text.cast("binary"), 256)


def prefix_of(full):
    """The first 32 bits of a digest."""
    return F.conv(F.substring(full, 1, 8), 16, 10).cast("long")


def rule_table(spark, rules) -> DataFrame:
    """Rules as a DataFrame (rule, verdict); a list is taken as it is, a DataFrame of any size as well."""
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(rules, "rule string, verdict string")
    slash = F.instr("rule", "/")
    return (
        rules.where("rule is not null")
        .groupBy("rule")
        .agg(F.max("verdict").alias("rule_verdict"))  # block wins over allow for one and the same rule
        .withColumn("path_length", F.when(slash > 0, F.length("rule") - slash + 1).otherwise(F.lit(0)))
        .withColumn("full", digest(F.col("rule")))
        .withColumn("short", prefix_of(F.col("full")))
    )


def parts(url):
    """(host, path) columns; both empty without `://` or for null."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(after, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def filter_urls(pages: DataFrame, rules=RULES, default: str = "allow") -> DataFrame:
    """One row per (page_id, url): host, path, the rule that decides (null: none) and the verdict.

    Null urls and those without `://` have an empty host and path and get `default`. Rows that repeat a page_id and
    url are one row; a page_id with two urls has two. An empty table gives an empty result; without rules all get
    `default`. Other columns are not read. Rules of one length that fit the same url are the same rule.

    The lengths of rule paths (numbers, no more than a url is long) go to the driver; the rules are broadcast
    only below `BROADCAST_RULES`, beyond that both sides are shuffled by digest prefix and hot prefixes are split.
    """
    spark = pages.sparkSession
    known = rule_table(spark, rules)
    lengths = sorted(r[0] for r in known.select("path_length").distinct().collect())
    few = known.count() <= BROADCAST_RULES
    host, path = parts(F.col("url"))
    urls = pages.select("page_id", "url").select("page_id", "url", host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    sized = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path"))
    prefixes = F.transform(sized, lambda n: F.substring(F.col("path"), F.lit(1), n))
    pairs = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    expanded = (
        urls.withColumn("expressions", pairs)
        .select("page_id", "url", "host", "path", F.explode_outer("expressions").alias("expression"))
        .withColumn("own", digest(F.col("expression")))
        .withColumn("own_short", prefix_of(F.col("own")))
        .drop("expression")
    )
    side = known.select("rule", "rule_verdict", "full", "short")
    side = F.broadcast(side) if few else side
    met = expanded.join(side, (F.col("own_short") == F.col("short")) & (F.col("own") == F.col("full")), "left")
    best = F.max(F.when(F.col("rule").isNotNull(), F.struct(F.length("rule").alias("n"), "rule", "rule_verdict")))
    return (
        met.groupBy("page_id", "url", "host", "path")
        .agg(best.alias("best"))
        .select(
            "page_id",
            "host",
            "path",
            F.col("best.rule").alias("rule"),
            F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
        )
    )
