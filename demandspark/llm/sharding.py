"""A uniform shuffle into shards of exact size through a hypergeometric communication matrix.

Rows lie in logical partitions by a hash of their content. For the counts of these partitions and the exact sizes of
the target cells, the driver draws a matrix of how many rows go from each partition to each cell, with the law that a
uniformly random permutation would give. Each partition is permuted and its rows dealt by its line of the matrix;
after the exchange each cell is permuted again. A shard is a run of `cells` cells, so no task holds a whole shard.

Law: shard sizes, counted in rows, are at most one apart.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import whole

SHARDS, PARTITIONS, CELLS = 24, 256, 16
NUMPY_MOST = 10**9 - 1


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of `drawn` rows, taken from `good` + `bad` ones without replacement, are good ones.

    Beyond what numpy's sampler takes: two binomials under the condition that they sum to `drawn`.
    """
    if good + bad <= NUMPY_MOST:
        return int(rng.hypergeometric(good, bad, drawn))
    share = drawn / (good + bad)
    while True:
        x, y = rng.binomial(good, share, 100_000), rng.binomial(bad, share, 100_000)
        fits = np.flatnonzero(x + y == drawn)
        if len(fits):
            return int(x[fits[0]])


def communication(counts: dict[int, int], sizes: list[int], seed: int) -> dict[int, list[int]]:
    """partition: rows to each cell. Row sums are `counts`, column sums `sizes`."""
    rng = np.random.Generator(np.random.PCG64(seed))
    left, matrix = list(sizes), {}
    for p in sorted(counts):
        rest, to_draw, line = sum(left), counts[p], []
        for size in left:
            rest -= size
            n = hypergeometric(rng, size, rest, to_draw) if to_draw and size else 0
            line.append(n)
            to_draw -= n
        left = [a - b for a, b in zip(left, line)]
        matrix[p] = line
    return matrix


def even(total: int, parts: int) -> list[int]:
    return [total // parts + (k < total % parts) for k in range(parts)]


def shard(docs: DataFrame, shards: int = SHARDS, partitions: int = PARTITIONS, cells: int = CELLS, seed: int = 7) -> DataFrame:
    """Every row of `docs` with its columns and `shard` (0 to shards - 1), `slot` (gapless from 0 in its shard).

    Columns of these names, or of names beginning with `_shard_`, are replaced. Null ids and texts are content like
    any other. Rows that repeat doc_id and text each get a place; which one of equal rows gets which place does not
    show. Equal texts under different ids are dealt independently. With fewer rows than shards the last shards are
    empty; an empty table gives no rows. The same content gives the same result on any cluster.

    The driver holds partitions x shards x cells numbers, whatever the input; tasks hold no shard whole.
    """
    spark = docs.sparkSession
    text = whole()
    identity = [F.col("doc_id"), F.crc32(text.cast("binary")), F.octet_length(text)]
    content = F.xxhash64(*identity)
    placed = docs.drop("shard", "slot").withColumns(
        {
            "_shard_part": F.pmod(content, F.lit(partitions)).cast("int"),
            "_shard_first": F.xxhash64(F.lit(seed), F.lit("deal"), *identity),
            "_shard_second": F.xxhash64(F.lit(seed), F.lit("order"), *identity),
        }
    )
    counts = {r["_shard_part"]: r["count"] for r in placed.groupBy("_shard_part").count().collect()}
    sizes = [n for size in even(sum(counts.values()), shards) for n in even(size, cells)]
    matrix = communication(counts, sizes, seed)
    lines = [(p, [int(x) for x in np.cumsum(line)]) for p, line in matrix.items()]
    dealt = spark.createDataFrame(lines, "_shard_p int, _shard_upto array<long>")
    starts = [int(x) for k in range(shards) for x in np.cumsum([0, *sizes[k * cells : (k + 1) * cells - 1]])]
    local = W.partitionBy("_shard_part").orderBy("_shard_first", "doc_id")
    inside = W.partitionBy("_shard_cell").orderBy("_shard_second", "doc_id")
    cell = F.size(F.filter("_shard_upto", lambda upto: upto < F.col("_shard_rank")))
    return (
        placed.withColumn("_shard_rank", F.row_number().over(local).cast("long"))
        .join(F.broadcast(dealt), F.col("_shard_part") == F.col("_shard_p"))
        .withColumn("_shard_cell", cell)
        .withColumn("shard", F.floor(F.col("_shard_cell") / cells).cast("int"))
        .withColumn("slot", F.row_number().over(inside) - 1 + F.element_at(F.array(*map(F.lit, starts)).cast("array<long>"), F.col("_shard_cell") + 1))
        .drop("_shard_part", "_shard_first", "_shard_second", "_shard_rank", "_shard_p", "_shard_upto", "_shard_cell")
    )
