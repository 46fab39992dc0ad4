"""Least squares from mergeable moments: counts, sums and cross products as one aggregate.

A table of moments by any keys (a group, a week) is the input of every linear fit over these keys: moments of a union
are sums of moments, so a later range of weeks or a coarser group needs no second look at the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pairs(width: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(width) for j in range(i, width)]


def moments(df: DataFrame, feats: list[str], label: str, by: list[str] = ()) -> DataFrame:
    """(by, n, sums, products) over the rows without a NULL among features and label; one map-side combined aggregate.

    `sums` and `products` list the features and then the label; products have i <= j, row by row.
    """
    columns = [F.col(c).cast("double") for c in (*feats, label)]
    rows = df.dropna(subset=[*feats, label])
    return rows.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(c) for c in columns]).alias("sums"),
        F.array(*[F.sum(columns[i] * columns[j]) for i, j in pairs(len(columns))]).alias("products"),
    )


def merged(table: DataFrame, width: int, by: list[str] = ()) -> DataFrame:
    """Moments of coarser keys; `width` is the number of features and the label."""
    add = lambda name, size: F.array(*[F.sum(F.get(name, F.lit(k))) for k in range(size)]).alias(name)
    return table.groupBy(*by).agg(F.sum("n").alias("n"), add("sums", width), add("products", width * (width + 1) // 2))


def solved(n: float, sums: np.ndarray, products: np.ndarray, width: int, l2: float) -> np.ndarray:
    """Intercept and slopes; features that do not vary have slope 0."""
    cross = np.zeros((width, width))
    cross[np.triu_indices(width)] = products
    cross = cross + np.triu(cross, 1).T - np.outer(sums, sums) / n
    spread = np.sqrt(np.maximum(np.diag(cross)[:-1], 0))
    use = spread > 1e-9 * np.sqrt(np.abs(products[np.cumsum([0, *range(width, 1, -1)])][:-1]) + 1e-300)
    slopes = np.zeros(width - 1)
    if use.any():
        gram = cross[:-1, :-1][np.ix_(use, use)] + l2 * np.eye(int(use.sum()))
        slopes[use] = np.linalg.lstsq(gram, cross[:-1, -1][use], rcond=None)[0]
    return np.concatenate([[(sums[-1] - slopes @ sums[:-1]) / n], slopes])


def ridge(table: DataFrame, feats: list[str], l2: float = 0.1, by: list[str] = ()) -> DataFrame:
    """(by, n, intercept, slopes): the coefficients that minimise the squared errors plus `l2` times the squared slopes.

    The intercept is free. One row of moments is one small system, solved where the row is.
    """
    width = len(feats) + 1
    own = [table.schema[c] for c in by]
    out = T.StructType([*own, T.StructField("n", T.LongType()), T.StructField("intercept", T.DoubleType()), T.StructField("slopes", T.ArrayType(T.DoubleType()))])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [solved(n, np.asarray(s, float), np.asarray(p, float), width, l2) for n, s, p in zip(batch["n"], batch["sums"], batch["products"])]
            made = batch[[*by, "n"]].copy()
            made["intercept"] = [r[0] for r in rows]
            made["slopes"] = [r[1:].tolist() for r in rows]
            yield made

    return table.where("n > 0").select(*by, "n", "sums", "products").mapInPandas(work, out)


def predict(coefficients: DataFrame, rows: DataFrame, feats: list[str], by: list[str] = ()) -> DataFrame:
    """`rows` with `predicted`; rows without coefficients drop out. Without `by` there is one row of coefficients."""
    own = coefficients.select(*by, F.col("intercept").alias("_intercept"), F.col("slopes").alias("_slopes"))
    joined = rows.join(own, list(by)) if by else rows.crossJoin(F.broadcast(own))
    value: Column = F.col("_intercept")
    for k, f in enumerate(feats):
        value = value + F.get("_slopes", F.lit(k)) * F.col(f).cast("double")
    return joined.withColumn("predicted", value).drop("_intercept", "_slopes")
