"""Trained models: shape, range, repeatability and gain over the naive forecast."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.operators import aggregates, baselines, evaluate, models, series_models
from demandspark.operators.series_models import arima, boost

Y, CUT = "weekly_quantity", "2024-W26"


@pytest.fixture(scope="module")
def halves(spark):
    """Twelve seasonal series of two years and one with three weeks only."""
    rng = np.random.default_rng(3)
    weeks = [f"{y}-W{w:02d}" for y in (2023, 2024) for w in range(1, 53)]
    data = [
        (f"s{s}", w, float(max(0, 100 * (1 + s) + 60 * np.sin(i * np.pi / 2) * (1 + s) + rng.normal(0, 3))), 2.0 + s)
        for s in range(12)
        for i, w in enumerate(weeks)
    ]
    data += [("short", w, 5.0, 1.0) for w in ("2024-W25", "2024-W26", "2024-W27")]
    df = spark.createDataFrame(pd.DataFrame(data, columns=["sku", "year_week", Y, "avg_unit_price"]))
    return baselines.split(models.model_features(df, ["sku"]).cache(), CUT)


def check(preds, test, n=None):
    rows = preds.collect()
    assert len(rows) == (test.count() if n is None else n)
    assert all(r["predicted"] is not None and np.isfinite(r["predicted"]) and r["predicted"] >= 0 for r in rows)
    return rows


def wmape(preds):
    return preds.where("sku <> 'short'").agg(evaluate.wmape(F.col("actual"), F.col("predicted"))).first()[0]


def test_global_model_beats_naive_and_repeats(halves):
    train, test = halves
    preds = models.gbt_global(train, test, ["sku"], models.GLOBAL_FEATURES, Y, iters=8)
    rows = check(preds, test)
    again = models.gbt_global(train, test, ["sku"], models.GLOBAL_FEATURES, Y, iters=8).collect()
    assert sorted(rows) == sorted(again)
    assert wmape(preds) < wmape(baselines.naive_last(train, test, ["sku"], Y))


def test_entity_models_fall_back_for_short_series(halves):
    train, test = halves
    preds = models.gbt_by_entity(train, test, ["sku"], models.GLOBAL_FEATURES, Y, trees=30, global_iters=3)
    rows = check(preds, test)
    kinds = {(r["sku"], r["model_type"]) for r in rows}
    assert ("short", "global") in kinds and ("s0", "sku") in kinds and len(kinds) == 13
    assert wmape(preds) < wmape(baselines.naive_last(train, test, ["sku"], Y))
    again = models.gbt_by_entity(train, test, ["sku"], models.GLOBAL_FEATURES, Y, trees=30, global_iters=3)
    assert sorted(rows) == sorted(again.collect())


def test_series_cut_by_batch_borders_are_fitted_whole(spark, halves):
    train, test = halves
    want = sorted(models.gbt_by_entity(train, test, ["sku"], models.GLOBAL_FEATURES, Y, trees=10, global_iters=2).collect())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        got = sorted(models.gbt_by_entity(train, test, ["sku"], models.GLOBAL_FEATURES, Y, trees=10, global_iters=2).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want


def test_group_pattern_and_linear_models(halves):
    train, test = halves
    grouped = models.gbt_by_group(
        train.withColumn("g", F.when(F.col("sku") == "short", "x").otherwise("y")),
        test.withColumn("g", F.when(F.col("sku") == "short", "x").otherwise("y")),
        ["sku"], "g", models.GLOBAL_FEATURES, Y, iters=2,
    )
    kinds = {(r["sku"] == "short", r["model_type"]) for r in check(grouped, test)}
    assert kinds == {(True, "global"), (False, "category")}
    patterns = aggregates.pattern_v31(train, ["sku"])
    check(models.by_pattern(train, test, ["sku"], models.GLOBAL_FEATURES, Y, patterns, trees=10), test, 12 * 26)
    check(models.linear(train, test, ["sku"], models.GLOBAL_FEATURES, Y), test)


def test_importance_and_scoring(spark, halves):
    train, test = halves
    model = models.fit(train, models.GLOBAL_FEATURES, Y, iters=3)
    table = models.importance(model, models.GLOBAL_FEATURES)
    assert table.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    row = spark.createDataFrame([(100.0, 90.0, 80.0, None, 2.0, 30, 0)], "lag1 double, lag2 double, lag4 double, rolling_avg_4w double, avg_unit_price double, week_num int, is_w47 int")
    assert models.score(model, row, models.GLOBAL_FEATURES).first()["predicted"] >= 0


def test_auto_arima(spark):
    rng = np.random.default_rng(4)
    weeks = [f"{y}-W{w:02d}" for y in (2023, 2024) for w in range(1, 53)]
    noise, level = rng.normal(0, 2, len(weeks)), [50.0]
    for e in noise[1:]:
        level.append(50 + 0.8 * (level[-1] - 50) + e)
    data = [("ar", w, float(v)) for w, v in zip(weeks, level)] + [("flat", w, 9.0) for w in weeks] + [("few", w, 1.0) for w in weeks[:5]]
    out = models.auto_arima(spark.createDataFrame(data, "e string, year_week string, y double"), ["e"], "y", h=6)
    rows = out.orderBy("e", "step").collect()
    assert [r["e"] for r in rows] == ["ar"] * 6 + ["flat"] * 6
    assert rows[0]["year_week"] == "2025-W01"
    assert all(r["lower_bound"] <= r["forecast"] <= r["upper_bound"] for r in rows)
    widths = [r["upper_bound"] - r["lower_bound"] for r in rows[:6]]
    assert widths == sorted(widths) and rows[6]["forecast"] == 9.0 and rows[6]["upper_bound"] == 9.0


def test_arima_holidays_and_steps(spark):
    from demandspark.operators.series_models import level_steps

    weeks = [f"{y}-W{w:02d}" for y in (2022, 2023, 2024) for w in range(1, 53)]
    data = [("a", w, 300.0 if w.endswith(("W01", "W02")) else 100.0 + (i % 3)) for i, w in enumerate(weeks)]
    df = spark.createDataFrame(data, "e string, year_week string, y double")
    rows = {r["year_week"]: r["forecast"] for r in models.auto_arima(df, ["e"], "y", h=4, holiday_weeks=(1, 2)).collect()}
    assert rows["2025-W01"] > 250 and rows["2025-W02"] > 250
    assert 90 < rows["2025-W03"] < 115 and 90 < rows["2025-W04"] < 115
    step = np.r_[np.full(30, 10.0), np.full(30, 50.0)]
    assert np.allclose(level_steps(step), 50.0)
    wave = 10 + np.sin(np.arange(60.0))
    assert (level_steps(wave) == wave).all()


def test_autoregression_recovers_its_order():
    rng = np.random.default_rng(5)
    y = [10.0]
    for e in rng.normal(0, 1, 400):
        y.append(10 + 0.9 * (y[-1] - 10) + e)
    points, error, order = arima(np.array(y), 50)
    assert order.startswith("arima(") and abs(points[-1] - 10) < 2 and error[0] == pytest.approx(1.0, abs=0.15)


def test_moving_average_is_recovered():
    """A pure moving average: one step ahead follows the last error, from the second step on it is the mean."""
    rng = np.random.default_rng(11)
    e = rng.normal(0, 1, 3001)
    y = 50 + e[1:] + 0.8 * e[:-1]
    points, error, order = arima(y, 6, max_p=0)
    assert order == "arima(0,0,1)" or order == "arima(0,0,2)"
    assert points[0] == pytest.approx(50 + 0.8 * e[-1], abs=0.35) and points[3:] == pytest.approx(50, abs=0.2)
    assert error[0] == pytest.approx(1.0, abs=0.1) and error[-1] == pytest.approx(np.sqrt(1.64), abs=0.15)
    mixed = [0.0]
    for k in range(1, 3000):
        mixed.append(0.7 * mixed[-1] + e[k] + 0.5 * e[k - 1])
    assert "0)" not in arima(np.array(mixed), 2, max_p=1, max_q=1)[2][-2:]
    assert arima(np.array(mixed), 2, max_p=2)[1][0] == pytest.approx(1.0, abs=0.1)


def test_any_interval_level(spark):
    assert baselines.normal_quantile(0.95) == pytest.approx(1.959963984540054)
    weeks = [(f"2024-W{w:02d}", 10.0 + w % 5) for w in range(1, 30)]
    df = spark.createDataFrame([("a", *r) for r in weeks], "e string, year_week string, y double")
    narrow, wide = (models.auto_arima(df, ["e"], "y", h=2, level=v).orderBy("step").first() for v in (0.5, 0.99))
    assert narrow["upper_bound"] < wide["upper_bound"]


def test_drawn_rows_do_not_depend_on_company(spark):
    """Volatile series: the same forecasts under other partitions and batches, and with other series beside them."""
    rng = np.random.default_rng(12)
    weeks = [f"2024-W{w:02d}" for w in range(1, 53)]
    data = [(f"s{s}", w, float(rng.gamma(0.3, 50)), 1.0) for s in range(8) for w in weeks]
    df = spark.createDataFrame(data, ["sku", "year_week", Y, "avg_unit_price"])
    train, test = baselines.split(models.model_features(df, ["sku"]).cache(), CUT)
    kinds = train.select("sku").distinct().withColumn("pattern", F.lit("volatile"))

    def run(keep="true"):
        out = models.by_pattern(train.where(keep), test.where(keep), ["sku"], models.GLOBAL_FEATURES, Y, kinds, trees=20)
        return sorted(out.collect())

    want = run()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions, batch in (("1", "10000"), ("8", "100")):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            assert run() == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert run("sku = 's5'") == [r for r in want if r["sku"] == "s5"]


def test_series_without_a_key_stay_whole(spark):
    data = [(None, f"{2020 + i // 50}-W{i % 50 + 1:02d}", float(i % 7)) for i in range(120)]
    df = spark.createDataFrame(data, "sku string, year_week string, y double")
    schema = T.StructType([T.StructField("n", T.IntegerType())])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        pieces = models.per_series(df, ["sku"], "year_week", lambda rows: pd.DataFrame({"n": [len(rows)]}), schema)
        assert [r["n"] for r in pieces.collect()] == [120]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_incomplete_rows_count_only_as_zeros_when_asked(halves):
    train, test = halves
    core = ["lag1", "lag4"]
    table = {r["sku"]: r for r in models.training_rows(train, ["sku"], core).collect()}
    assert (table["short"]["n_rows"], table["short"]["n_complete"], table["short"]["eligible"]) == (2, 0, False)
    assert table["s0"]["n_rows"] - table["s0"]["n_complete"] == 4 and table["s0"]["eligible"]
    strict = models.gbt_by_entity(train, test, ["sku"], models.GLOBAL_FEATURES, Y, trees=5, global_iters=2, core=core)
    assert strict.where("sku = 'short'").count() == 0 and strict.count() == test.count() - 1


def test_classes_are_scored_on_held_out_customers(spark):
    rows = [(f"c{k}", 2 + k % 5, float(k % 3), "abc"[k % 3]) for k in range(300)]
    dim = spark.createDataFrame(rows, "customer_id string, total_orders int, x double, cycle_regularity string")
    scored = models.cycle_classifier(dim, ["x"], rounds=3).collect()
    assert 20 < len(scored) < 120
    assert all(sum(r["class_probs"].values()) == pytest.approx(1.0) and set(r["class_probs"]) == {"a", "b", "c"} for r in scored)
    assert all(r["predicted_label"] == r["actual_label"] for r in scored)


def test_settings_are_compared_as_listed(spark, halves):
    settings = [{"iters": 2, "depth": 2, "step": 0.1}, {"iters": 3, "depth": 3, "step": 0.05}]
    out = models.ts_cv(halves[0], ["sku"], models.GLOBAL_FEATURES, Y, settings, splits=2).collect()
    assert sorted((r["iters"], r["depth"], r["step"]) for r in out) == [(2, 2, 0.1), (3, 3, 0.05)]
    assert sum(r["is_best"] for r in out) == 1 and all(r["cv_mae"] > 0 for r in out)


def test_boosting_many_series_equals_boosting_each_alone():
    rng = np.random.default_rng(6)
    n, s = 30, 9
    series, x = np.repeat(np.arange(s), n), rng.normal(size=(n * s, 5)).round(1)
    y, train = 4 * x[:, 0] + rng.normal(size=n * s), np.tile(np.arange(n) < 18, s)
    together = boost(series, x, y, train, trees=25)
    for k in range(s):
        own = series == k
        alone = boost(np.zeros(n, int), x[own], y[own], train[own], trees=25)
        assert np.allclose(alone, together[own], atol=1e-6)
    assert np.abs(together - y)[train].mean() < np.abs(y - y.mean())[train].mean() / 3


@pytest.mark.parametrize("subsample,min_leaf,depth", [(1.0, 2, 5), (0.8, 3, 4), (1.0, 1, 3)])
def test_short_and_long_series_grow_the_same_trees(monkeypatch, subsample, min_leaf, depth):
    """series side by side in arrays against rows grouped by node, with ties, few rows and mixed lengths."""
    rng = np.random.default_rng(21)
    lengths = rng.integers(1, 46, 90)
    series = rng.permutation(np.repeat(np.arange(90), lengths + 5))
    x = rng.normal(size=(len(series), 6)).round(1)
    x[:, 2], x[:, 3] = rng.integers(0, 3, len(series)), 0.0
    x[::7, 4] = np.inf
    y = 10.0 ** (series % 4) * (x[:, 0] + x[:, 2] + rng.normal(size=len(series)))
    left, train = lengths.copy(), np.zeros(len(series), bool)
    for k in rng.permutation(len(series)):
        train[k] = left[series[k]] > 0
        left[series[k]] -= 1
    settings = (40, depth, 0.1, min_leaf, subsample, 5, np.arange(90) * 17)
    short = boost(series, x, y, train, *settings)
    monkeypatch.setattr(series_models, "SHORT", 20)
    mixed = boost(series, x, y, train, *settings)
    monkeypatch.setattr(series_models, "SHORT", 0)
    long = boost(series, x, y, train, *settings)
    assert np.allclose(short, long, rtol=1e-9) and np.allclose(mixed, long, rtol=1e-9)
    assert np.ptp(short - (np.bincount(series[train], y[train]) / lengths)[series]) > 1


def test_small_fits_take_many_series_at_a_time(spark):
    """batches are gathered, and a series cut by a border stays whole."""
    df = spark.createDataFrame([(f"s{i // 10}", f"2024-W{i % 10 + 1:02d}") for i in range(200)], "sku string, year_week string").coalesce(1)
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("series", T.IntegerType())])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        work = lambda rows: pd.DataFrame({"n": [len(rows)], "series": [rows["sku"].nunique()]})
        pieces = models.per_series(df, ["sku"], "year_week", work, schema, 100).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sum(r["n"] for r in pieces) == 200 and all(r["n"] == 10 * r["series"] for r in pieces)
    fewer = spark.sparkContext.defaultParallelism * 2
    assert len(pieces) <= fewer


def test_boosting_splits_neighbouring_doubles():
    low = 1.1
    x = np.array([low, np.nextafter(low, 2)] * 6 + [np.nextafter(low, 2)])[:, None]
    y = np.where(x[:, 0] > low, 5.0, 1.0)
    train = np.arange(13) < 12
    with np.errstate(all="raise"):
        out = boost(np.zeros(13, int), x, y, train, trees=80)
    assert np.allclose(out, y, atol=0.01)


def test_boosting_survives_constant_and_tiny_signals():
    rng = np.random.default_rng(8)
    series, x = np.repeat(np.arange(60), 20), rng.normal(size=(1200, 4)).round(1)
    x[:, 0] = 0.0
    y = np.where(series % 3 == 0, 7.0, np.where(series % 3 == 1, 5 + 1e-5 * x[:, 1], x[:, 2]))
    train = np.tile(np.arange(20) < 6, 60)
    with np.errstate(all="raise"):
        out = boost(series, x, y, train, trees=60)
    assert np.isfinite(out).all() and np.allclose(out[series % 3 == 0], 7.0)


def test_encode_and_splits(spark, rows):
    fit_on = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "k string")
    df = spark.createDataFrame([("c",), ("z",), (None,), ("a",)], "k string")
    assert rows(models.encode(df, fit_on, "k"), "k") == [(None, -1), ("a", 0), ("c", 2), ("z", -1)]
    weeks = spark.createDataFrame([(f"2024-W{w:02d}",) for w in range(1, 9)], "year_week string")
    folds = models.ts_splits(weeks, 3)
    for fold in (1, 2, 3):
        part = folds.where(F.col("fold") == fold)
        last = part.where("role = 'train'").agg(F.max("year_week")).first()[0]
        first = part.where("role = 'test'").agg(F.min("year_week")).first()[0]
        assert last < first and part.where("role = 'test'").count() == 2


def test_ensemble_weights(spark):
    def preds(v):
        return spark.createDataFrame([("a", "2024-W30", 10.0, v), ("b", "2024-W30", 10.0, v)], "sku string, year_week string, actual double, predicted double")

    patterns = spark.createDataFrame([("a", "cyclical"), ("b", "other")], "sku string, pattern string")
    weights = {"cyclical": {"m1": 0.4, "m2": 0.6}, "default": {"m1": 0.3, "m2": 0.7}}
    out = models.ensemble({"m1": preds(10.0), "m2": preds(20.0)}, weights, patterns, ["sku"], "default")
    assert {r["sku"]: r["predicted"] for r in out.collect()} == {"a": 16.0, "b": 17.0}


def test_fits_need_no_package_on_the_executors(tmp_path):
    """Workers start in another folder without this package on their path."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    script = """
import sys; sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
from demandspark.operators import models
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
weeks = spark.range(40).select(F.lit("a").alias("e"), F.concat(F.lit("2024-W"), F.lpad((F.col("id") + 1).cast("string"), 2, "0")).alias("year_week"), (F.col("id") % 4).cast("double").alias("y"))
print("steps", models.auto_arima(weeks, ["e"], "y", h=3).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    repo = str(Path(__file__).resolve().parent.parent)
    done = subprocess.run([sys.executable, "-c", script, repo], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "steps 3" in done.stdout, done.stderr[-2000:]


def wave_series(rng, n, phi=0.0, theta=0.0, mean=0.0, wave=0.0, summed=False):
    e = rng.normal(size=n + 60)
    w = np.zeros(n + 60)
    for t in range(1, n + 60):
        w[t] = phi * w[t - 1] + e[t] + theta * e[t - 1]
    w = w[60:].cumsum() if summed else w[60:]
    return mean + w + wave * np.sin(2 * np.pi * np.arange(n) / (365.25 / 7))


def with_gaps(rng, y, share=0.3):
    out = np.where(rng.random(len(y)) < share, np.nan, y)
    out[[0, -1]] = y[[0, -1]]
    return out


def plain_log_likelihood(y, phi, theta, mean, variance):
    """Of ARMA(1, 1) by the covariance of the values that are there."""
    n = len(y)
    g = np.empty(n)
    g[0] = 1 + (phi + theta) ** 2 / (1 - phi**2)
    g[1] = phi + theta + phi * (phi + theta) ** 2 / (1 - phi**2)
    for k in range(2, n):
        g[k] = phi * g[k - 1]
    at = np.flatnonzero(~np.isnan(y))
    cov = variance * g[np.abs(at[:, None] - at[None])]
    z = y[at] - mean
    return -0.5 * (len(at) * np.log(2 * np.pi) + np.linalg.slogdet(cov)[1] + z @ np.linalg.solve(cov, z))


def test_filter_gives_the_exact_likelihood_with_gaps():
    from demandspark.operators import series_models as m

    rng = np.random.default_rng(21)
    y = with_gaps(rng, wave_series(rng, 90, 0.6, 0.4, 3.0))
    seen = ~np.isnan(y)
    grid = np.stack([np.where(seen, y, 0.0), seen.astype(float)])[:, None]
    phi, theta = np.array([[0.6], [0], [0]]), np.array([[0.4], [0]])
    _, sums, logs, count = m.filtered(grid, seen[None], np.array([0]), phi, theta, 0)
    value, mean, variance = m.profiled(sums, logs, count, [1])
    assert value[0] == pytest.approx(plain_log_likelihood(y, 0.6, 0.4, mean[0, 0], variance[0]), abs=1e-6)
    assert value[0] >= plain_log_likelihood(y, 0.6, 0.4, mean[0, 0] + 0.1, variance[0]) and value[0] >= plain_log_likelihood(y, 0.6, 0.4, mean[0, 0], variance[0] * 1.1)


def test_a_yearly_wave_is_found_under_gaps():
    from demandspark.operators.series_models import arima_each

    rng = np.random.default_rng(22)
    whole = [wave_series(rng, 226, mean=100, wave=20) for _ in range(8)]
    fits = arima_each([with_gaps(rng, y[:200]) for y in whole], 26)
    assert all(name.endswith("+year") for _, _, name in fits)
    assert np.abs(np.array([f[0] for f in fits]) - 100 - 20 * np.sin(2 * np.pi * np.arange(200, 226) / (365.25 / 7))).max() < 2
    flat = arima_each([with_gaps(rng, wave_series(rng, 200, mean=100)) for _ in range(8)], 4)
    assert sum(name.endswith("+year") for _, _, name in flat) <= 2
    short = arima_each([wave_series(rng, 60, mean=100, wave=20)], 4)
    assert not short[0][2].endswith("+year")


@pytest.mark.parametrize("kind", [{"phi": 0.7, "mean": 50}, {"theta": 0.6, "mean": 50}, {"phi": 0.4, "mean": 20, "wave": 5}, {"phi": 0.3, "summed": True}])
def test_intervals_cover_what_they_say(kind):
    """80 % intervals of four weeks ahead, 600 series with a third of their weeks missing; three points off at most."""
    from demandspark.operators.series_models import arima_each

    rng = np.random.default_rng(23)
    whole = [wave_series(rng, 244, **kind) for _ in range(600)]
    fits = arima_each([with_gaps(rng, y[:240]) for y in whole], 4)
    inside = np.mean([np.abs(y[240:] - f[0]) <= 1.2815515655 * f[1] for y, f in zip(whole, fits)])
    assert inside == pytest.approx(0.8, abs=0.03)


def test_missing_weeks_stay_missing(spark):
    """Every third week alone tells the same level as all weeks, not a third of it."""
    weeks = [f"{y}-W{w:02d}" for y in (2023, 2024) for w in range(1, 53)]
    data = [("all", w, 90.0 + i % 5) for i, w in enumerate(weeks)] + [("few", w, 90.0 + i % 5) for i, w in enumerate(weeks) if i % 3 == 0]
    out = models.auto_arima(spark.createDataFrame(data, "e string, year_week string, y double"), ["e"], "y", h=3).collect()
    assert len(out) == 6 and all(85 < r["forecast"] < 99 for r in out)


def test_a_series_does_not_depend_on_its_company():
    from demandspark.operators.series_models import arima_each

    rng = np.random.default_rng(24)
    series = [with_gaps(rng, wave_series(rng, n, 0.5, mean=10, summed=k % 2 == 1)) for k, n in enumerate((40, 90, 90, 150, 30))]
    together = arima_each(series, 5)
    for y, (points, error, name) in zip(series, together):
        alone = arima_each([y], 5)[0]
        assert alone[2] == name and np.allclose(alone[0], points) and np.allclose(alone[1], error)


@pytest.mark.parametrize("d", [0, 1])
def test_factored_likelihoods_equal_the_filter(d):
    """covariances of what is there give what the week-by-week filter gives, for short and padded series."""
    from demandspark.operators import series_models as sm

    rng = np.random.default_rng(4)
    there = np.zeros((7, 200), bool)
    for i, n in enumerate((4, 9, 27, 27, 40, 64, 120)):
        there[i, np.r_[0, rng.choice(np.arange(1, 200), n - 1, replace=False)]] = True
    grid = np.cumsum(rng.normal(size=(4, 7, 200)), axis=2) if d else rng.normal(size=(4, 7, 200))
    grid = (grid - grid[:, :, :1] * d) * there
    of = rng.integers(0, 7, 90)
    u = np.clip(rng.normal(size=(sm.AR + sm.MA, 90)) * 1.5, -sm.REACH, sm.REACH) * (rng.random((sm.AR + sm.MA, 90)) < 0.6)
    phi, theta = sm.coefficients(u[: sm.AR]), -sm.coefficients(u[sm.AR :])
    _, sums, logs, count = sm.filtered(grid, there, of, phi, theta, d)
    got = sm.likelihoods(grid, there, of, phi, theta, d)
    upper = np.triu_indices(4)
    assert np.allclose(got[0][upper], sums[upper], rtol=1e-6, atol=1e-6) and np.allclose(got[1], logs, atol=1e-6) and (got[2] == count).all()


def test_short_series_of_few_values_are_not_stepped_week_by_week(monkeypatch):
    """only the chosen fit of a series runs over its weeks."""
    from demandspark.operators import series_models as sm

    lanes, real = [], sm.filtered
    monkeypatch.setattr(sm, "filtered", lambda grid, there, of, *rest: lanes.append(len(of)) or real(grid, there, of, *rest))
    rng = np.random.default_rng(1)
    made = sm.arima_each([sm.on_weeks(np.arange(0, 240, 8), rng.gamma(2, 9, 30)) for _ in range(5)], 4)
    assert len(made) == 5 and sum(lanes) == 5
