"""The histogram booster and the moment tables against plain numpy statements."""

from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandspark import session
from demandspark.operators import boosting, histograms, models, moments
from demandspark.operators.histograms import Settings

FEATS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(2)
    n = 900
    frame = pd.DataFrame({"a": rng.normal(size=n).round(2), "b": rng.integers(0, 5, n).astype(float), "c": rng.normal(size=n)})
    frame["y"] = np.where(frame["a"] > 0.3, 5.0, 1.0) * (1 + frame["b"]) + rng.normal(0, 0.1, n)
    frame["k"] = ((frame["a"] > 0).astype(int) + (frame["b"] > 2)).astype(int)
    frame["id"] = np.arange(n)
    return frame


@pytest.fixture(scope="module")
def rows(spark, table):
    numbers = F.when(F.col("id") % 3 == 0, F.array(F.lit(0).cast("long"))).otherwise(F.array(F.lit(0).cast("long"), (F.col("id") % 3).cast("long")))
    return spark.createDataFrame(table).withColumn("m", numbers).cache()


def as_frame(nodes):
    return nodes.toPandas().sort_values(["model", "tree", "output", "node"]).reset_index(drop=True)


def plain_tree(x, g, h, cuts, s):
    """Recursive growth over every (feature, cut): (rows, value) of the leaves."""
    leaves = []

    def grow(own, level):
        G, H = g[own].sum(), h[own].sum()
        best = None
        if level < s.depth and H >= s.min_split:
            for f, edges in enumerate(cuts):
                for edge in edges:
                    left = own[x[own, f] <= edge]
                    hl, gl = h[left].sum(), g[left].sum()
                    if hl >= s.min_leaf and H - hl >= s.min_leaf:
                        gain = gl**2 / (hl + s.l2) + (G - gl) ** 2 / (H - hl + s.l2) - G**2 / (H + s.l2)
                        if best is None or gain > best[0] + 1e-7 * (1 + best[0]):
                            best = (gain, f, edge)
        if best is None or best[0] <= 1e-9 * (1 + abs(G)):
            leaves.append((own, s.step * G / (H + s.l2)))
            return
        low = x[own, best[1]] <= best[2]
        grow(own[low], level + 1)
        grow(own[~low], level + 1)

    grow(np.arange(len(x)), 0)
    return leaves


def plain_boost(x, y, cuts, s):
    k = max(1, s.classes)
    if s.classes:
        raw = np.log((np.bincount(y.astype(int), minlength=k) + 1) / (len(y) + k))[:, None].repeat(len(y), 1)
    else:
        raw = np.full((1, len(y)), y.mean())
    for _ in range(s.iters):
        if s.classes:
            p = np.exp(raw) / np.exp(raw).sum(0)
            g, h = (y == np.arange(k)[:, None]) - p, p * (1 - p)
        else:
            g, h = y - raw, np.ones_like(raw)
        raw = raw.copy()
        for c in range(k):
            for own, value in plain_tree(x, g[c], h[c], cuts, s):
                raw[c, own] += value
    return raw


@pytest.mark.parametrize("s", [Settings(4, 3, 0.3), Settings(3, 2, 0.3, 1.0, 0.0, 1.0, 3)])
def test_booster_equals_plain_growth(table, rows, s):
    label = "k" if s.classes else "y"
    nodes = boosting.fit_models(rows, FEATS, label, settings=s, bins=16)
    edges = boosting.bin_edges(rows, FEATS, 16)
    want = plain_boost(table[FEATS].to_numpy(), table[label].to_numpy(float), [edges[f] for f in FEATS], s)
    got = boosting.predict(nodes, rows, FEATS, classes=bool(s.classes)).orderBy("id").toPandas()["predicted"]
    if s.classes:
        assert np.allclose(np.stack(got), (np.exp(want) / np.exp(want).sum(0)).T, atol=1e-8)
    else:
        assert np.allclose(got, want[0], atol=1e-8)


@pytest.mark.parametrize("s", [Settings(10, 3, 0.3), Settings(2, 2, 0.3, 1.0, 0.0, 1.0, 3)])
def test_large_models_grow_the_same_trees_level_by_level(rows, s):
    """Models over the row bound take a job a level; 10 rounds cross the writing of the state."""
    label = "k" if s.classes else "y"
    whole = as_frame(boosting.fit_models(rows, FEATS, label, "m", s, 16))
    level = as_frame(boosting.fit_models(rows, FEATS, label, "m", s, 16, task_rows=400))  # model 0 only
    assert set(whole["model"]) == {0, 1, 2}
    pd.testing.assert_frame_equal(whole, level, rtol=1e-6, atol=1e-9)


def test_level_jobs_do_not_grow_with_the_models(spark, rows):
    def jobs(models_of):
        group = f"fit-{models_of}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            boosting.fit_models(rows, FEATS, "y", models_of, Settings(2, 2), 8, task_rows=100)
            return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    assert abs(jobs("m") - jobs(None)) <= 4


def test_a_level_is_one_stage_and_leaves_nothing_behind(spark, rows, monkeypatch):
    """Jobs of levels shuffle nothing; the state written on the way is deleted; sums added up by model give the same."""
    root = Path(session.shared_dir(spark).removeprefix("file:"))
    before = {f for f in root.rglob("*") if f.is_file()}
    monkeypatch.setattr(boosting, "KEPT_TREES", 2)
    spark.sparkContext.setJobGroup("levels", "levels")
    try:
        level = as_frame(boosting.fit_models(rows, FEATS, "y", "m", Settings(7, 3), 16, task_rows=100))
        tracker = spark.sparkContext.statusTracker()
        stages = [len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup("levels")]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sum(n == 1 for n in stages) >= 7 * 3
    left = {f for f in root.rglob("*") if f.is_file()} - before
    assert not [f for f in left if "rdd-" in str(f)]
    monkeypatch.setattr(boosting, "GATHERED_BYTES", 0)
    added = as_frame(boosting.fit_models(rows, FEATS, "y", "m", Settings(7, 3), 16, task_rows=100))
    whole = as_frame(boosting.fit_models(rows, FEATS, "y", "m", Settings(7, 3), 16))
    pd.testing.assert_frame_equal(whole, level, rtol=1e-6, atol=1e-9)
    pd.testing.assert_frame_equal(whole, added, rtol=1e-6, atol=1e-9)


def test_functions_of_tasks_need_no_package():
    from pyspark import cloudpickle

    for f in (boosting.unpacked, boosting.node_rows, boosting.raw_scores):
        assert b"_make_function" in cloudpickle.dumps(f)


def test_models_of_a_set_equal_models_alone(rows):
    s = Settings(5, 3, 0.2)
    together = as_frame(boosting.fit_models(rows, FEATS, "y", "m", {m: s for m in range(3)}, 64))
    edges_of_all = boosting.bin_edges(rows, FEATS, 64)
    alone = boosting.fit_in_tasks(boosting.binned_rows(rows.where("id % 3 = 1"), FEATS, "y", "m", edges_of_all).where("model = 1"), FEATS, edges_of_all, lambda m: s, 64, 1)
    pd.testing.assert_frame_equal(together[together["model"] == 1].reset_index(drop=True), as_frame(alone), rtol=1e-9)


def test_many_models_are_scored_in_blocks(rows, monkeypatch):
    nodes = boosting.fit_models(rows, FEATS, "y", "m", Settings(3, 2), 16)
    code = F.when(F.col("id") % 5 == 0, None).when(F.col("id") % 5 == 1, 99).otherwise(F.col("id") % 3)
    whole = boosting.predict(nodes, rows, FEATS, code).select("id", "predicted").orderBy("id").toPandas()
    monkeypatch.setattr(boosting, "SCORED_MODELS", 1)
    blocks = boosting.predict(nodes, rows, FEATS, code).select("id", "predicted").orderBy("id").toPandas()
    pd.testing.assert_frame_equal(whole, blocks)
    assert whole["predicted"].isna().equals(whole["id"] % 5 <= 1)


def test_importance_is_the_share_of_gains(rows):
    nodes = boosting.fit_models(rows, FEATS, "y", settings=Settings(6, 3))
    gains = as_frame(nodes).groupby("feature")["gain"].sum()
    got = {r["feature"]: r["importance"] for r in boosting.importance(nodes, [*FEATS, "unused"]).collect()}
    assert got["unused"] == 0 and sum(got.values()) == pytest.approx(1)
    assert all(got[f] == pytest.approx(gains.get(f, 0) / gains.sum()) for f in FEATS)


def test_constant_labels_nulls_and_no_rows(spark, rows):
    flat = boosting.fit_models(rows.withColumn("y", F.lit(7.0)), FEATS, "y", settings=Settings(3, 2))
    assert boosting.predict(flat, rows, FEATS).agg(F.min("predicted"), F.max("predicted")).first() == (7.0, 7.0)
    holes = rows.withColumns({"a": F.when(F.col("id") % 2 == 0, F.col("a")), "y": F.when(F.col("id") % 7 > 0, F.col("y")), "b": F.lit(None).cast("double")})
    model = boosting.fit_models(holes, FEATS, "y", settings=Settings(3, 2))
    assert boosting.predict(model, holes, FEATS).where("predicted IS NULL OR isnan(predicted)").count() == 0
    none = boosting.fit_models(rows.limit(0), FEATS, "y", settings=Settings(3, 2))
    assert none.count() == 0 and boosting.predict(none, rows, FEATS).where("predicted IS NOT NULL").count() == 0


def test_joint_classes_are_not_worse_than_one_against_the_rest(spark):
    """Log loss on held-out rows beside scaled chances of separate two-class models of as many rounds; the classes overlap."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(2000, 3))
    k = (x @ rng.normal(size=(3, 4)) * 1.5 + rng.gumbel(size=(2000, 4))).argmax(1)
    df = spark.createDataFrame(pd.DataFrame(np.c_[x, k, np.arange(2000)], columns=[*FEATS, "k", "id"])).cache()
    train, test = df.where("id % 4 > 0"), df.where("id % 4 = 0")
    truth = test.orderBy("id").toPandas()["k"].to_numpy(int)

    def loss(p):
        return -np.log(np.clip(p[np.arange(len(truth)), truth], 1e-12, 1)).mean()

    def scored(df, label, classes):
        nodes = boosting.fit_models(df, FEATS, label, settings=Settings(50, 5, 0.1, 1.0, 0.0, 1.0, classes))
        return np.stack(boosting.predict(nodes, test, FEATS, classes=True).orderBy("id").toPandas()["predicted"])

    joint = scored(train, "k", 4)
    assert np.allclose(joint.sum(1), 1)
    rest = np.stack([scored(train.withColumn("own", (F.col("k") == c).cast("int")), "own", 2)[:, 1] for c in range(4)], 1)
    assert loss(joint) <= loss(rest / rest.sum(1, keepdims=True))


def test_moments_add_up_and_solve_ridge(spark, table, rows):
    by_part = moments.moments(rows.withColumn("part", F.col("id") % 4), FEATS, "y", ["part"])
    whole = moments.merged(by_part, 4)
    direct = moments.moments(rows, FEATS, "y")
    for a, b in zip(whole.first()[1:], direct.first()[1:]):
        assert np.allclose(a, b)
    got = moments.ridge(whole, FEATS, 2.5).first()
    x, y = table[FEATS].to_numpy(), table["y"].to_numpy()
    xc = x - x.mean(0)
    slopes = np.linalg.solve(xc.T @ xc + 2.5 * np.eye(3), xc.T @ (y - y.mean()))
    assert np.allclose(got["slopes"], slopes) and got["intercept"] == pytest.approx(y.mean() - slopes @ x.mean(0))
    pred = moments.predict(moments.ridge(whole, FEATS, 2.5), rows, FEATS).orderBy("id").toPandas()["predicted"]
    assert np.allclose(pred, got["intercept"] + x @ slopes)
    same = moments.ridge(moments.moments(rows.withColumn("b", F.lit(3.0)), FEATS, "y"), FEATS).first()
    assert same["slopes"][1] == 0 and np.isfinite(same["intercept"])
    assert moments.ridge(moments.moments(rows.limit(0), FEATS, "y"), FEATS).count() == 0


def test_chances_sum_to_one():
    raw = np.array([[1000.0, -5.0], [0.0, -5.0]])
    assert np.allclose(histograms.chances(raw).sum(0), 1) and np.isfinite(histograms.chances(raw)).all()


def test_settings_take_the_names_of_the_fit(rows):
    model = models.fit(rows, FEATS, "y", iters=2, depth=2, step=0.5)
    assert as_frame(model)["tree"].max() == 1 and as_frame(model)["node"].max() <= 7


def test_rows_go_down_trees_in_blocks(monkeypatch):
    """blocks of rows, leaves above the last level, roots alone and infinite values end where one row at a time does."""
    rng = np.random.default_rng(6)
    tree = histograms.Tree(3)
    for node, f, cut in ((1, 0, 3), (2, 1, 2), (5, 2, 4), (3, 2, 0)):
        tree.feature[node], tree.cut[node] = f, cut
    bins = rng.integers(0, 8, (3, 501)).astype(np.uint8)

    def walk(column, levels):
        node = 1
        for _ in range(levels):
            if tree.feature[node] >= 0:
                node = 2 * node + int(column[tree.feature[node]] > tree.cut[node])
        return node

    monkeypatch.setattr(histograms, "ROUTED_ROWS", 64)
    for levels in range(4):
        assert (tree.route(bins, np.ones(501, np.int64), levels) == [walk(c, levels) for c in bins.T]).all()
    x = bins.T.astype(float)
    x[::9, 0] = np.inf
    value = rng.normal(size=len(tree.feature))
    stump = np.full(len(tree.feature), -1, np.int16)
    outputs = [(np.stack([tree.feature, stump]), np.stack([tree.cut, tree.cut]).astype(float), np.stack([value, value]))]
    want = [2.0 + value[walk(row, 3)] + value[1] for row in x]
    assert np.allclose(boosting.raw_scores(x, np.array([2.0]), outputs)[0], want)
    assert boosting.raw_scores(x[:0], np.array([2.0]), outputs).shape == (1, 0)
