"""Exact Jaccard join of documents on word n-grams by prefix filters under several global orders.

If two sets reach the similarity, they share a token among the first p of each, under any order of all tokens.

The first order ranks the tokens of a share of the hash space by how many rows hold them, and puts all others
after them by hash. So of the tokens of all texts only that share is counted and shuffled (a set that has too few of
them adds others); it is half as large again as a prefix's share of its set, so that few prefixes need others. Sets
without a shared token among their first p drop out, which most do.

The second order ranks all tokens of the sets that are left, again the rarest first. A group is a token with a range
of set sizes; sets that share a group are candidates if the tokens before the shared one leave enough to share, which
holds at the first token that a linked pair shares. A third order, by another hash, must give a shared token as well:
its prefixes are short, and are compared first. Only pairs that pass all orders fetch their whole sets.

Candidates are not all pairs of a group. Its sets are first compared with one of them, its hub. Links join sets to
components; then only sets of different components are compared, with eight times as many hubs each round while such
pairs are many, and all that are left in the end. No link between components is lost.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks, shingles
from .common import drop, drop_since, only, opened, written
from .links import components
from .shingles import ORDERS, prefix, set_id, tokens
from .symbols import mixed

N, PERCENT = 3, 90
PENDING = 64

register_pickle_by_value(shingles)


def per_text(docs: DataFrame, n: int, schema: str, columns, make) -> DataFrame:
    """Rows that `make` gives for every text, by its doc_id, key and tokens, as a tuple of columns; None for no row."""
    names, types = zip(*columns)

    def work(batches):
        for batch in batches:
            held, size = [], 0
            for doc_id, key, data in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "key", "data"))):
                row = make(doc_id, key, tokens(data, n))
                if row is None:
                    continue
                held.append(row)
                size += len(row[0])
                if size > 200_000:
                    yield joined(held)
                    held, size = [], 0
            if held:
                yield joined(held)

    def joined(held):
        return pa.RecordBatch.from_arrays([pa.array([x for part in column for x in part] if isinstance(column[0], list) else np.concatenate(column), kind) for column, kind in zip(zip(*held), types)], list(names))

    return docs.select("doc_id", "key", "data").mapInArrow(work, schema)


def counted_below(percent: int) -> np.uint64:
    """The end of the hash space that the first order counts: sixteenths, at least 1.5 times a prefix's share."""
    sixteenths = -(-16 * 15 * (100 - percent) // 1000)
    return np.uint64(min(max(sixteenths, 1) << 60, (1 << 64) - 1))


def sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, key, size of the set, its id (0 for none), number of its tokens that the first order counts."""
    low_end = counted_below(percent)

    def make(doc_id, key, found):
        return [doc_id], [key], [len(found)], [set_id(found) if len(found) else 0], [int((found < low_end).sum())]

    columns = [("doc_id", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("set", pa.int64()), ("n_low", pa.int64())]
    return per_text(docs, n, "doc_id long, key long, n long, set long, n_low long", columns, make)


def ranked_tokens(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(token, set, high): the tokens that can be in a prefix of the first order."""
    low_end = counted_below(percent)

    def make(doc_id, key, found):
        low = int(np.searchsorted(found, low_end))
        upto = max(low, min(prefix(len(found), percent), len(found)))
        if not upto:
            return None
        return found[:upto].view(np.int64), np.full(upto, set_id(found)), np.arange(upto) >= low

    columns = [("token", pa.int64()), ("set", pa.int64()), ("high", pa.bool_())]
    return per_text(docs, n, "token long, set long, high boolean", columns, make)


def whole_sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(set, n, tokens, other): whole sets, and their prefixes under the third order."""

    def make(doc_id, key, found):
        p = prefix(len(found), percent)
        other = np.partition(mixed(found ^ ORDERS[0]), min(p, len(found)) - 1)[:p]
        return [set_id(found)], [len(found)], [found.view(np.int64)], [other.view(np.int64)]

    kind = pa.list_(pa.int64())
    columns = [("set", pa.int64()), ("n", pa.int64()), ("tokens", kind), ("other", kind)]
    return per_text(docs, n, "set long, n long, tokens array<long>, other array<long>", columns, make)


def prefix_length(percent: int):
    return (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")


def first_candidates(docs: DataFrame, known: DataFrame, n: int, percent: int) -> DataFrame:
    """The sets (`_set`) that share a token with another one in their prefix under the first order."""
    ranked = ranked_tokens(docs, n, percent)
    counted = ranked.groupBy("token").agg(F.count("*").alias("df"), F.min("set").alias("a"), F.max("set").alias("b"))
    shared = written(counted.where("a <> b").select("token", "df"), "shared-tokens")
    kept = written(ranked.join(shared, "token"), "ranked-tokens")
    ordered = kept.groupBy("set").agg(F.sort_array(F.collect_set(F.struct("high", "df", "token"))).alias("tokens"))
    size = known.select(F.col("set").alias("_set"), "n", "n_low")
    # tokens of one set only stand before all others of the counted share; beyond it only those were listed that are
    # in the prefix
    shared_low = F.size(F.filter("tokens", lambda t: ~t["high"]))
    left = F.greatest(prefix_length(percent) - (F.col("n_low") - shared_low), F.lit(0)).cast("int")
    taken = F.concat(F.slice("tokens", F.lit(1), F.least(left, shared_low)), F.filter("tokens", lambda t: t["high"]))
    rows = ordered.join(size, F.col("set") == F.col("_set")).select("set", "n", F.explode(F.transform(taken, lambda t: t["token"])).alias("token"))
    rows = written(rows.withColumnRenamed("token", "t").select("set", grouped("t", percent)), "first-prefixes", few_files=True)
    drop(shared, kept)
    met = written(rows.groupBy("token").agg((F.min("set") < F.max("set")).alias("meet")).where("meet").select("token"), "met", few_files=True)
    candidates = written(rows.join(met, "token", "left_semi").select(F.col("set").alias("_set")).distinct(), "candidates", few_files=True)
    drop(rows, met)
    return candidates


def grouped(token: str, percent: int):
    """The groups of a token, with `lower`: similar sets are in the same range of sizes or in neighbouring ones.

    A set is in the group of its range and, as a lower one, in the next; two lower ones meet in the group before.
    """
    scale = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent)) if percent < 100 else F.col("n")
    each = [F.struct(F.xxhash64(F.col(token), scale + k).alias("token"), F.lit(bool(k)).alias("lower")) for k in (0, 1)]
    return F.inline(F.array(*each))


def prefix_rows(content: DataFrame, percent: int) -> DataFrame:
    """Prefixes under the second order: token (a group), set, n, place, before, lower; tokens of one set only are left out.

    `place` is how many tokens stand before the one at hand, `before` the shared one right before it.
    """
    each = content.select("set", F.explode("tokens").alias("t"))
    shared = written(each.groupBy("t").agg(F.count("*").alias("df")).where("df > 1"), "shared-tokens", few_files=True)
    kept = each.join(shared, "t").groupBy("set").agg(F.sort_array(F.collect_list(F.struct("df", "t"))).alias("tokens"))
    size = content.select(F.col("set").alias("_set"), "n")
    joined = kept.join(size, F.col("set") == F.col("_set"))
    # tokens that only one set has stand before all others
    alone = F.col("n") - F.size("tokens")
    first = F.slice("tokens", F.lit(1), F.greatest(prefix_length(percent) - alone, F.lit(0)).cast("int"))
    rows = joined.select("set", "n", alone.alias("alone"), first.alias("first"), F.posexplode(first).alias("k", "t"))
    before = F.when(F.col("k") > 0, F.get("first", F.col("k") - 1)["t"]).otherwise(F.col("set"))
    rows = rows.select("set", "n", (F.col("alone") + F.col("k")).cast("int").alias("place"), before.alias("before"), F.col("t.t").alias("t"))
    out = written(rows.select("set", "n", "place", "before", grouped("t", percent)), "prefixes", few_files=True)
    drop(shared)
    return out


COLUMNS = ("set", "n", "place", "before", "lower")


def fits(percent: int):
    """Whether a pair may be similar and this is the group to find it in.

    Its sizes allow the similarity, and enough tokens are left from the shared one on. If both have the same shared
    token right before, that one's group finds the pair; if both are lower, the range's own group does.
    """
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    most = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    enough = most * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent
    return sizes & enough & (F.col("before_a") != F.col("before_b")) & ~(F.col("lower_a") & F.col("lower_b"))


def hubs_of(rows: DataFrame, count: int) -> DataFrame:
    """Of each token at most `count` sets, spread over its sets by hash; written."""
    part = F.pmod("set", F.lit(count))
    hubs = rows.groupBy(F.col("token").alias("_token"), part.alias("part")).agg(F.min(F.struct(*COLUMNS, "component")).alias("hub"))
    return written(hubs.select("_token", "hub"), "hubs", few_files=True)


def hub_pairs(rows: DataFrame, hubs: DataFrame, percent: int) -> DataFrame:
    """Each set with the hubs of its token, if their components differ."""
    side = hubs.select("_token", F.col("hub.component").alias("_component"), *(F.col(f"hub.{c}").alias(f"{c}_a") for c in COLUMNS))
    own = rows.select("token", "component", *(F.col(c).alias(f"{c}_b") for c in COLUMNS))
    pairs = own.join(side, (F.col("token") == F.col("_token")) & (F.col("component") != F.col("_component")) & fits(percent))
    low, high = (f(F.struct("set_a", "n_a"), F.struct(F.col("set_b").alias("set_a"), F.col("n_b").alias("n_a"))) for f in (F.least, F.greatest))
    ordered = pairs.select(low.alias("x"), high.alias("y"))
    return ordered.select(F.col("x.set_a").alias("a"), F.col("x.n_a").alias("n_a"), F.col("y.set_a").alias("b"), F.col("y.n_a").alias("n_b"))


def cross_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """All pairs of sets of different components that share a token; made from pairs of components."""
    names = ("place", "low", "high", "before_low", "before_high", "lower")
    values = (F.min("place"), F.min("n"), F.max("n"), F.min("before"), F.max("before"), F.bool_and("lower"))
    groups = rows.groupBy("token", "component").agg(*(v.alias(name) for name, v in zip(names, values)))
    groups = written(groups, "token-components", few_files=True)
    x, y = groups.alias("x"), groups.alias("y")
    # what `fits` asks, as far as it holds for some pair of their sets
    sizes = (F.col("x.high") * 100 >= F.col("y.low") * percent) & (F.col("y.high") * 100 >= F.col("x.low") * percent)
    most = F.least(F.col("x.high") - F.col("x.place"), F.col("y.high") - F.col("y.place"))
    enough = most * (100 + percent) >= (F.col("x.low") + F.col("y.low")) * percent
    same = (F.col("x.before_low") == F.col("y.before_high")) & (F.col("x.before_high") == F.col("y.before_low"))
    some = sizes & enough & ~same & ~(F.col("x.lower") & F.col("y.lower"))
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.component") < F.col("y.component")) & some)
    pairs = pairs.select(F.col("x.token").alias("_token"), F.col("x.component").alias("_a"), F.col("y.component").alias("_b"))
    side = lambda name: rows.select(F.col("token").alias(f"t_{name}"), F.col("component").alias(f"c_{name}"), *(F.col(c).alias(f"{c}_{name}") for c in COLUMNS))
    met = pairs.join(side("a"), (F.col("_token") == F.col("t_a")) & (F.col("_a") == F.col("c_a")))
    met = met.join(side("b"), (F.col("_token") == F.col("t_b")) & (F.col("_b") == F.col("c_b")) & fits(percent))
    return met.select(F.col("set_a").alias("a"), "n_a", F.col("set_b").alias("b"), "n_b")


def beside(pairs: DataFrame, content: DataFrame, column: str) -> DataFrame:
    """`pairs` (a, b) with this column of both sets."""
    for name in ("a", "b"):
        side = content.select(F.col("set").alias("_set"), F.col(column).alias(f"{column}_{name}"))
        pairs = pairs.join(side, F.col(name) == F.col("_set")).drop("_set")
    return pairs


def verified(pairs: DataFrame, content: DataFrame, percent: int) -> DataFrame:
    """Of candidate pairs the links (a, b): prefixes meet under the third order as well, and the whole sets are similar."""
    pairs = written(pairs.groupBy("a", "b").agg(F.min("n_a").alias("n_a"), F.min("n_b").alias("n_b")), "pairs", few_files=True)
    met = beside(pairs, content, "other").where(F.arrays_overlap("other_a", "other_b")).select(*pairs.columns)
    met = written(met, "pairs-of-all-orders", few_files=True)
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    similar_sets = both * 100 >= (F.col("n_a") + F.col("n_b") - both) * percent
    links = written(beside(met, content, "tokens").where(similar_sets).select("a", "b"), "links", few_files=True)
    drop(pairs, met)
    return links


def with_components(rows: DataFrame, links: DataFrame) -> DataFrame:
    """`rows` with the component of each set; those of tokens whose sets are all in one component are left out."""
    found = written(components(links), "components", few_files=True)
    joined = rows.select("token", *COLUMNS).join(found, F.col("set") == F.col("node"), "left")
    labelled = written(joined.select("token", *COLUMNS, F.coalesce("component", "set").alias("component")), "labelled", few_files=True)
    apart = labelled.groupBy(F.col("token").alias("_token")).agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("_token")
    apart = written(apart, "apart", few_files=True)
    out = written(labelled.join(apart, F.col("token") == F.col("_token"), "left_semi"), "open")
    drop(found, labelled, apart)
    return out


def similar(docs: DataFrame, known: DataFrame, n: int, percent: int) -> DataFrame:
    """(node, component) of every set that is linked with another one; written, all else is dropped."""
    spark = docs.sparkSession
    before = opened()
    candidates = first_candidates(docs, known, n, percent)
    one_each = known.join(candidates, F.col("set") == F.col("_set"), "left_semi").select(F.col("doc_id").alias("_doc"))
    texts = docs.join(one_each, F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi")
    content = written(whole_sets(texts, n, percent).dropDuplicates(["set"]), "sets")
    drop(candidates)
    prefixes = prefix_rows(content, percent)
    links = spark.createDataFrame([], "a long, b long")
    rows = prefixes.withColumn("component", F.col("set"))
    count = 1
    while True:
        sizes = rows.groupBy("token", "component").agg(F.count("*").alias("c")).groupBy("token").agg(F.sum("c").alias("g"), F.sum(F.col("c") * F.col("c")).alias("s"))
        total, pending = sizes.agg(F.coalesce(F.sum("g"), F.lit(0)), F.coalesce(F.sum((F.col("g") * F.col("g") - F.col("s")) / 2), F.lit(0))).first()
        if pending == 0:
            break
        if count > 1 and pending <= PENDING * total:
            links = links.unionAll(verified(cross_pairs(rows, percent), content, percent))
            break
        hubs = hubs_of(rows, count)
        links = links.unionAll(verified(hub_pairs(rows, hubs, percent), content, percent))
        # a hub has met all others of its token
        met = hubs.select("_token", F.col("hub.set").alias("_hub"))
        rest = rows.join(met, (F.col("token") == F.col("_token")) & (F.col("set") == F.col("_hub")), "left_anti")
        after = with_components(rest, links)
        drop(hubs, prefixes if count == 1 else rows)
        rows, count = after, count * 8
    out = written(components(links), "linked", few_files=True)
    drop_since(before, out)
    return out


def near_duplicates(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """One row per row of `docs`: doc_id, text_key, n_shingles, component (null without shingles), component_id.

    Words are what stands between white space (0x20, 0x09 to 0x0D), A-Z in lower case. A text with fewer than n words
    has one shingle, all of it; null, empty and wordless texts have none and are linked with nothing: their component
    is their own id. component_id is the smallest id reachable; null ids are reachable and reach, but never name a
    component unless it has no other. Rows of one id are documents of their own. An empty table gives no rows. Other
    columns are not read. Sets, and shingles, are equal where their 64-bit hashes are.
    """
    texts = blocks.keyed(docs).select("doc_id", "key", "data")
    found = written(sets(texts, n, percent), "set-ids")
    known = found.where("n > 0").groupBy("set").agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), F.min("n_low").alias("n_low"))
    known = written(known, "known-sets")
    linked = similar(texts, known, n, percent)
    named = known.join(linked, F.col("set") == F.col("node"), "left").select("set", "doc_id", F.coalesce("component", "set").alias("component"))
    named = written(named, "named-sets", few_files=True)
    least = written(named.groupBy(F.col("component").alias("_component")).agg(F.min("doc_id").alias("component_id")), "least-ids", few_files=True)
    by_set = named.join(least, F.col("component") == F.col("_component")).select(F.col("set").alias("_set"), "component", "component_id")
    by_set = written(by_set, "components-by-set", few_files=True)
    drop(known, linked, named, least)
    joined = found.join(by_set, F.col("set") == F.col("_set"), "left")
    smallest = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("key").alias("text_key"), F.col("n").alias("n_shingles"), "component", smallest.alias("component_id"))


def one_of_each(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` with one document of each component, that of the smallest (doc_id, text_key), null ids last.

    Documents without shingles (null, empty and wordless texts) stay. Rows equal in id and text are one document, so they
    stay or go together. An empty table gives no rows; other columns pass as they are. Only the list of documents that
    stay is kept on disk beside `docs`.
    """
    before = opened()
    found = near_duplicates(docs, n, percent)
    order = F.struct(F.coalesce("doc_id", F.lit(blocks.LAST)), "text_key", "doc_id")
    first = found.where("n_shingles > 0").groupBy("component").agg(F.min(order).alias("first")).select("first.doc_id", "first.text_key")
    stay = written(first.unionAll(found.where("n_shingles = 0").select("doc_id", "text_key").distinct()), "one-of-each", few_files=True)
    drop_since(before, stay)
    return only(docs, stay)
