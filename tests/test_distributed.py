import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandspark.functions import distributed as dist


def test_percentiles_are_exact_on_small_ties_and_large_groups(spark):
    rng = np.random.default_rng(1)
    data = pd.concat(
        [
            pd.DataFrame({"g": "hot", "v": np.r_[rng.normal(size=6_000), np.full(4_000, 0.25)]}),
            pd.DataFrame({"g": "wide", "v": rng.exponential(1e6, 3_001)}),
            pd.DataFrame({"g": "near", "v": 1e6 + np.arange(2_000) * 1e-6}),
            pd.DataFrame({"g": "tiny", "v": rng.normal(size=501) * 1e-12}),
            pd.DataFrame({"g": "mixed", "v": np.r_[-np.arange(50.0), np.zeros(7), rng.exponential(9, 80)]}),
            pd.DataFrame({"g": "pair", "v": [1.0, 2.0]}),
            pd.DataFrame({"g": "one", "v": [5.0]}),
            pd.DataFrame({"g": [None] * 4, "v": [1.0, 2.0, 3.0, None]}),
        ]
    )
    df = spark.createDataFrame(data).repartition(8).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    probs = {"lo": 0.0, "q": 0.25, "m": 0.5, "p": 0.9, "hi": 1.0}
    got = {r["g"]: r for r in dist.exact_percentiles(df, ["g"], "v", probs).collect()}
    assert len(got) == 8
    for name, part in data.groupby("g", dropna=False):
        row = got[None if pd.isna(name) else name]
        for column, prob in probs.items():
            assert row[column] == pytest.approx(part["v"].quantile(prob), rel=1e-12), (name, column)


def test_global_percentile(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    assert dist.exact_percentiles(df, [], "v", {"m": 0.5, "p": 0.905}).first().asDict() == {"m": 50.0, "p": pytest.approx(90.5)}


@pytest.mark.parametrize("method,pandas_method", [("rank", "min"), ("average", "average")])
@pytest.mark.parametrize("descending", [True, False])
def test_rank_of_large_groups(spark, method, pandas_method, descending):
    rng = np.random.default_rng(2)
    data = pd.DataFrame({"id": range(3_000), "g": rng.choice(["a", "b", "c"], 3_000, p=[0.8, 0.19, 0.01]), "y": rng.normal(0, 50, 3_000).round(0)})
    data.loc[5, "y"] = None
    df = spark.createDataFrame(data).withColumn("y", F.when(~F.isnan("y"), F.col("y")))
    got = dist.rank_large(df, ["g"], "y", "r", method, descending).toPandas().set_index("id")["r"].sort_index()
    want = data.groupby("g")["y"].rank(method=pandas_method, ascending=not descending)
    assert np.allclose(got.astype(float).to_numpy(), want.to_numpy(), equal_nan=True)


def test_number_rows_is_gapless_and_ordered(spark):
    df = spark.range(5_000).select((F.col("id") * 7919 % 5_000).alias("k")).repartition(7)
    got = dist.number_rows(df, ["k"], "n").toPandas()
    assert (got.sort_values("k")["n"].to_numpy() == np.arange(1, 5_001)).all()


def test_ranks_tell_large_whole_numbers_apart(spark):
    base = 2**53
    df = spark.createDataFrame([("g", base + k, k) for k in (3, 1, 0, 2)], "g string, y long, id int")
    got = {r["id"]: r["r"] for r in dist.rank_large(df, ["g"], "y", "r", descending=False).collect()}
    assert got == {0: 1, 1: 2, 2: 3, 3: 4}
