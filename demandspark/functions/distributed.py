"""Exact order statistics and numbering that never gather one group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import pin

def key_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join with a table of one row per key, NULL matching NULL; without keys that is a single row.

    The null-safe condition gives the join its own shuffle. A plain join with a grouped
    table would reuse the grouping's partitions, and AQE could then not split a hot key.
    """
    if not keys:
        return left.crossJoin(F.broadcast(right))
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def order_bins(key: Column) -> tuple[Column, Column]:
    """Coarse and fine integers that grow with `key`: 2^12 and 2^28 steps per doubling of its size.

    A fine bin spans few nanounits of its values, so it holds at most some million distinct doubles.
    """
    size = F.least(F.log2(F.abs(key)) + 1100, F.lit(2200.0))
    scaled = F.when(key == 0, 0.0).otherwise(F.signum(key) * size)
    return F.floor(scaled * (1 << 12)), F.floor(scaled * (1 << 28))


def running(by: list[str], order: str):
    """Values up to the current row of a group."""
    return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)


def exact_percentiles(df: DataFrame, by: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Linearly interpolated quantiles per group, exact for groups of any size.

    One pass merges equal values. Counts per coarse bin tell which bins hold the wanted
    ranks, counts per fine bin narrow them down, and only the values of those fine bins
    are ordered. No task orders more than the bins of a group or the values of a bin.
    """
    names = list(probs)
    values = df.select(*by, F.col(value).cast("double").alias("_v"))
    coarse, fine = order_bins(F.col("_v"))
    merged = (
        values.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
        .groupBy(*by, "_v")
        .agg(F.count("*").alias("_c"))
        .withColumns({"_b1": coarse, "_b2": fine})
    )

    def holding(counted: DataFrame) -> DataFrame:
        """Rows whose rank range [_cum - _c, _cum) holds a wanted rank."""
        wanted = F.filter(
            "_q", lambda q: (F.floor(q["pos"]) < F.col("_cum")) & (F.ceil(q["pos"]) >= F.col("_cum") - F.col("_c"))
        )
        return counted.withColumn("_q", wanted).where(F.size("_q") > 0)

    targets = F.array(
        *[F.struct(F.lit(i).alias("i"), ((F.col("_n") - 1) * F.lit(probs[n])).alias("pos")) for i, n in enumerate(names)]
    )
    level1 = merged.groupBy(*by, "_b1").agg(F.sum("_c").alias("_c"))
    level1 = level1.withColumns(
        {"_cum": F.sum("_c").over(running(by, "_b1")), "_n": F.sum("_c").over(Window.partitionBy(*by))}
    ).withColumn("_q", targets)
    kept1 = holding(level1).select(*by, "_b1", (F.col("_cum") - F.col("_c")).alias("_before"), "_q")
    near = key_join(merged, kept1, [*by, "_b1"])
    level2 = (
        near.groupBy(*by, "_b1", "_b2")
        .agg(F.sum("_c").alias("_c"), F.first("_before").alias("_before"), F.first("_q").alias("_q"))
        .withColumn("_cum", F.col("_before") + F.sum("_c").over(running([*by, "_b1"], "_b2")))
    )
    kept2 = holding(level2).select(*by, "_b2", (F.col("_cum") - F.col("_c")).alias("_before"), "_q")
    leaf = key_join(near.select(*by, "_b2", "_v", "_c"), kept2, [*by, "_b2"]).withColumn(
        "_cum", F.col("_before") + F.sum("_c").over(running([*by, "_b2"], "_v"))
    )
    hits = holding(leaf).select(*by, "_v", "_c", "_cum", F.inline("_q"))

    def at(rank: Column) -> Column:
        here = (rank < F.col("_cum")) & (rank >= F.col("_cum") - F.col("_c"))
        return F.max(F.when(here, F.col("_v")))

    ends = hits.groupBy(*by, "i").agg(
        F.first("pos").alias("pos"), at(F.floor("pos")).alias("_a"), at(F.ceil("pos")).alias("_b")
    )
    quantile = F.col("_a") + (F.col("pos") - F.floor("pos")) * (F.col("_b") - F.col("_a"))
    return (
        ends.select(*by, "i", quantile.alias("_q"))
        .groupBy(*by)
        .agg(*[F.max(F.when(F.col("i") == i, F.col("_q"))).alias(n) for i, n in enumerate(names)])
    )


def rank_large(
    df: DataFrame, by: list[str], y: str, name: str = "rank", method: str = "rank", descending: bool = True
) -> DataFrame:
    """Rank within groups of any size.

    Equal values are merged first. Rank = values in earlier coarse bins + in earlier fine
    bins of the own coarse bin + earlier values of the own fine bin.
    """
    key = (-F.col(y) if descending else F.col(y)).cast("double")
    coarse, fine = order_bins(F.col("_k"))
    values = (
        df.where(F.col(y).isNotNull())
        .groupBy(*by, y)
        .agg(F.count("*").alias("_c"))
        .withColumn("_k", key)
        .withColumns({"_b1": coarse, "_b2": fine})
    )

    def earlier(keys: list[str], order: str) -> Column:
        return F.sum("_c").over(running(keys, order)) - F.col("_c")

    # the innermost order is that of the column itself: doubles do not tell large whole numbers apart
    own = F.desc(y) if descending else F.asc(y)

    level2 = values.groupBy(*by, "_b1", "_b2").agg(F.sum("_c").alias("_c"))
    level1 = level2.groupBy(*by, "_b1").agg(F.sum("_c").alias("_c"))
    starts1 = level1.select(*by, "_b1", earlier(by, "_b1").alias("_s1"))
    starts2 = level2.select(*by, "_b1", "_b2", earlier([*by, "_b1"], "_b2").alias("_s2"))
    starts = key_join(starts2, starts1, [*by, "_b1"]).select(*by, "_b2", (F.col("_s1") + F.col("_s2")).alias("_start"))
    inner = values.withColumn("_inside", earlier([*by, "_b2"], own))
    rank = 1 + F.col("_start") + F.col("_inside")
    if method == "average":
        rank = rank + (F.col("_c") - 1) / 2
    ranked = key_join(inner, starts, [*by, "_b2"]).select(*by, y, rank.alias(name))
    return key_join(df, ranked, [*by, y], "left")


def number_rows(df: DataFrame, order: list[Column | str], name: str, start: int = 1) -> DataFrame:
    """Consecutive numbers over a total order, without one task seeing every row.

    The rows are range-sorted and pinned, so the numbers survive a lost executor; only
    the row count of each partition is accumulated.
    """
    position = F.monotonically_increasing_id()
    pinned = pin(df.orderBy(*order).withColumn("_pos", position))
    split = pinned.withColumns(
        {"_part": F.shiftright("_pos", 33), "_pos": F.col("_pos").bitwiseAND((1 << 33) - 1)}
    )
    sizes = split.groupBy("_part").agg(F.count("*").alias("_c"))
    starts = sizes.select(
        "_part",
        F.coalesce(
            F.sum("_c").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_start"),
    )
    # one row per partition of the sort
    return (
        split.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_pos") + start)
        .drop("_part", "_pos", "_start")
    )
