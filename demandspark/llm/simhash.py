"""SimHash near-duplicates by a grid join on the bit counts of fingerprint segments.

A fingerprint's 32 segments of two bits become 32 bit counts. Their Manhattan distance is never more than the number
of bits that differ, so it is tested first. Counts are kept as bars (0, 1 or 2 ones), so that the distance is the bit
count of an XOR.

The grid: the counts fall into `reach` + `FIXED` groups. Where the distance is at most `reach`, at least `FIXED` groups
of counts are equal; so each choice of that many groups is a grid, its cells are the counts in them, and linked
fingerprints share a cell of some grid. Cells with one fingerprint drop out.

Cells of many fingerprints are not paired out. Their points are first compared with one of them, a hub; links make
components, and only points of different components are compared further, with eight times as many hubs each round
while such pairs outnumber the points in cells, and all that are left in the end. No link between components is lost.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, small_batches, whole, written
from .links import components

SHINGLE, SEED, REACH = 4, 42, 4
FIXED = 4
PENDING = 2
CHUNK = 1 << 16
EVEN = 0x5555555555555555


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp) of every row; a bit of fp is set where more than half of the shingles' hashes have it."""

    def fingerprint(data: bytes) -> int:
        words = data.lower().split()  # of bytes: A-Z and 0x20, 0x09 to 0x0D only
        if not words:
            return 0
        ends = np.cumsum([len(w) + 1 for w in words])
        size = min(shingle, len(words))
        text = b" ".join(words)
        stops = (ends[size - 1 :] - 1).tolist()
        starts = [0, *ends[: len(stops) - 1].tolist()]
        digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
        for at in range(0, len(stops), CHUNK):
            hashes = np.array([digest(text[a:b], seed) for a, b in zip(starts[at : at + CHUNK], stops[at : at + CHUNK])], np.uint64)
            total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        return int(np.packbits(2 * total > len(stops), bitorder="little").view(np.int64)[0])

    def work(batches):
        for batch in batches:
            found = [fingerprint(value.as_py()) for value in batch.column("data")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())], ["doc_id", "fp"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().cast("binary").alias("data")).mapInArrow(work, "doc_id long, fp long")


def bars(fp: Column) -> Column:
    """The bit count of each two-bit segment as a bar of ones from its low bit on."""
    upper = F.shiftrightunsigned(fp, 1)
    low, high = fp.bitwiseOR(upper).bitwiseAND(F.lit(EVEN)), fp.bitwiseAND(upper).bitwiseAND(F.lit(EVEN))
    return low.bitwiseOR(F.shiftleft(high, 1))


def masks(reach: int) -> list[int]:
    """The bits of every choice of `FIXED` among reach + FIXED groups of whole segments."""
    n = reach + FIXED
    edges = [2 * (32 * k // n) for k in range(n + 1)]
    groups = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [signed(sum(chosen)) for chosen in combinations(groups, FIXED)]


def cells(points: DataFrame, reach: int) -> DataFrame:
    """(cell, fp, bars): every point in a cell of each grid."""
    each = F.array(*[F.xxhash64(F.lit(k), F.col("bars").bitwiseAND(F.lit(mask))) for k, mask in enumerate(masks(reach))])
    return points.select("fp", bars(F.col("fp")).alias("bars")).select(F.explode(each).alias("cell"), "fp", "bars")


def close(a: str, b: str, reach: int) -> Column:
    """The Manhattan distance of the bit counts first, then the fingerprints themselves."""
    differ = lambda x: F.bit_count(F.col(f"{x}_{a}").bitwiseXOR(F.col(f"{x}_{b}")))
    return (differ("bars") <= reach) & (differ("fp") <= reach)


def side(rows: DataFrame, name: str) -> DataFrame:
    return rows.select(*(F.col(c).alias(f"{c}_{name}") for c in ("cell", "component", "fp", "bars")))


def hub_links(rows: DataFrame, hubs: DataFrame, reach: int) -> DataFrame:
    """Links (a, b) of points with the hubs of their cell in other components."""
    same_cell = (F.col("cell_a") == F.col("cell_b")) & (F.col("component_a") != F.col("component_b"))
    return side(rows, "a").join(side(hubs, "b"), same_cell & close("a", "b", reach)).select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b"))


def cross_links(rows: DataFrame, reach: int) -> DataFrame:
    """Links of all points of a cell that are in different components, by way of pairs of components."""
    groups = written(rows.select("cell", "component").distinct(), "cell-components", few_files=True)
    x, y = groups.alias("x"), groups.alias("y")
    pairs = x.join(y, (F.col("x.cell") == F.col("y.cell")) & (F.col("x.component") < F.col("y.component")))
    pairs = pairs.select(F.col("x.cell").alias("cell"), F.col("x.component").alias("low"), F.col("y.component").alias("high"))
    met = pairs.join(side(rows, "a"), (F.col("cell") == F.col("cell_a")) & (F.col("low") == F.col("component_a")))
    met = met.join(side(rows, "b"), (F.col("cell") == F.col("cell_b")) & (F.col("high") == F.col("component_b")) & close("a", "b", reach))
    return met.select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b"))


def relabelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """`rows` with the component of each point, without cells that lie in one component."""
    found = written(components(links), "components", few_files=True)
    joined = rows.select("cell", "fp", "bars").join(found, F.col("fp") == F.col("node"), "left")
    labelled = written(joined.select("cell", "fp", "bars", F.coalesce("component", "fp").alias("component")), "labelled")
    apart = labelled.groupBy(F.col("cell").alias("_cell")).agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("_cell")
    out = written(labelled.join(apart, F.col("cell") == F.col("_cell"), "left_semi"), "open-cells")
    drop(found, labelled)
    return out


def linked(points: DataFrame, reach: int = REACH) -> DataFrame:
    """(node, component) of the fingerprints (fp, distinct) that are linked with another one."""
    every = cells(points, reach)
    shared = written(every.groupBy(F.col("cell").alias("_cell")).agg(F.count("*").alias("c")).where("c > 1").select("_cell"), "shared-cells", few_files=True)
    # shared cells grow with the documents: they are never broadcast
    rows = written(every.join(shared.hint("merge"), F.col("cell") == F.col("_cell"), "left_semi").withColumn("component", F.col("fp")), "cells")
    drop(shared)
    found, count = [], 1
    while True:
        sizes = rows.groupBy("cell", "component").agg(F.count("*").alias("c")).groupBy("cell").agg(F.sum("c").alias("g"), F.sum(F.col("c") * F.col("c")).alias("s"))
        total, pending = sizes.agg(F.coalesce(F.sum("g"), F.lit(0)), F.coalesce(F.sum((F.col("g") * F.col("g") - F.col("s")) / 2), F.lit(0))).first()
        if pending == 0:
            break
        if count > 1 and pending <= PENDING * total:
            found.append(written(cross_links(rows, reach).distinct(), "links", few_files=True))
            break
        part = F.pmod(F.xxhash64("fp"), F.lit(count)).alias("part")
        hubs = rows.groupBy("cell", part).agg(F.min(F.struct("fp", "bars", "component")).alias("hub")).select("cell", "hub.*")
        hubs = written(hubs, "hubs", few_files=True)
        found.append(written(hub_links(rows, hubs, reach).distinct(), "links", few_files=True))
        # a hub has met all others of its cell
        met = hubs.select(F.col("cell").alias("_cell"), F.col("fp").alias("_fp"))
        rest = rows.join(met, (F.col("cell") == F.col("_cell")) & (F.col("fp") == F.col("_fp")), "left_anti")
        after = relabelled(rest, reduce(DataFrame.unionAll, found))
        drop(rows, hubs)
        rows, count = after, count * 8
    links = reduce(DataFrame.unionAll, found) if found else points.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    out = written(components(links), "linked", few_files=True)
    drop(rows, *found)
    return out


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, reach: int = REACH) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hex digits), component_id.

    Words are what stands between white space (0x20, 0x09 to 0x0D), A-Z in lower case; a text with fewer than `shingle`
    words is one shingle. Null, empty and wordless texts have the fingerprint zero and link like any other.
    Fingerprints link where at most `reach` of their 64 bits differ. component_id is the smallest doc_id reachable;
    null ids reach and are reachable, and name a component that has no other. Rows that repeat a doc_id or a text keep
    a row each. An empty table gives no rows. Other columns are not read.
    """
    if not 0 < reach <= 32 - FIXED:
        raise ValueError("reach must leave a segment for every group")
    found = written(fingerprints(docs, shingle, seed), "fingerprints")
    points = written(found.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "points", few_files=True)
    named = points.join(linked(points, reach), F.col("fp") == F.col("node"), "left").select("fp", "doc_id", F.coalesce("component", "fp").alias("component"))
    named = written(named, "named-points", few_files=True)
    least = named.groupBy(F.col("component").alias("_component")).agg(F.min("doc_id").alias("component_id"))
    by_point = written(named.join(least, F.col("component") == F.col("_component")).select(F.col("fp").alias("_fp"), "component_id"), "components-by-point", few_files=True)
    drop(points, named)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.join(by_point, F.col("fp") == F.col("_fp")).select("doc_id", hexed, "component_id")
