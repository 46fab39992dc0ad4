"""Boosted trees of many models by histograms: the fits behind M01-M05 and M08-M15.

Features are cut into bins once, at quantiles from mergeable sketches, and the binned rows are written. A model is a
number that each of its training rows carries, so groups, folds and settings are models of the same jobs.

Models of at most `TASK_ROWS` rows are dealt to tasks, each grown whole in one pass over its binned rows (a byte a
feature). Larger ones are grown level by level by all tasks together: each level is one job that sums the gradients and
hessians of all these models by (model, output, node, feature, bin); the driver gets these sums, whose number does not
depend on the rows, and picks every node's split. Both ways take the same sums, so they grow the same trees.

What comes out is a table of nodes. Scores, importances and first splits are read from it.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cpu_tasks, drop_folder, pin, shared_dir, unpin
from . import histograms
from .histograms import Settings, Tree

BINS = 64
ACCURACY = 100_000  # a bin's edge is off its rank by at most one in so many rows
TASK_ROWS = 500_000
KEPT_TREES = 16
GATHERED_BYTES = 1 << 26  # sums of a job that come to the driver by task
SCORED_MODELS = 256

# the tasks' functions travel with them, so executors need no copy of this package
register_pickle_by_value(histograms)
register_pickle_by_value(sys.modules[__name__])

NODES = "model long, tree int, output int, node int, feature string, threshold double, value double, gain double, weight double"


def number(col: str) -> Column:
    """A feature as a number; NULL and NaN count as zero."""
    value = F.col(col).cast("double")
    return F.when(F.isnan(value), 0.0).otherwise(F.coalesce(value, F.lit(0.0)))


def bin_edges(rows: DataFrame, feats: list[str], bins: int = BINS) -> dict[str, list[float]]:
    """Distinct inner edges of each feature's bins, at equal shares of the rows; one pass, `bins` numbers a feature."""
    shares = [k / bins for k in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(number(f), shares, ACCURACY).alias(f"q{k}") for k, f in enumerate(feats)]).first()
    return {f: sorted(set(found[k] or [])) for k, f in enumerate(feats)}


def binned_rows(rows: DataFrame, feats: list[str], label: str, models: str, edges: dict[str, list[float]]) -> DataFrame:
    """(model, y, bins): a row for each model of the array `models`, its bins as bytes."""
    cuts = [np.array(edges[f]) for f in feats]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(len(feats))], 1)
            flat = np.ascontiguousarray(histograms.binned(x, cuts).T)
            packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(len(feats)), len(flat), [None, pa.py_buffer(flat)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("models"), batch.column("y"), packed], ["models", "y", "bins"])

    plain = rows.where(F.col(label).isNotNull()).select(*[number(f).alias(f"f{k}") for k, f in enumerate(feats)], F.col(label).cast("double").alias("y"), F.col(models).alias("models"))
    return plain.mapInArrow(work, "models array<long>, y double, bins binary").select(F.explode("models").alias("model"), "y", "bins")


def unpacked(column: pa.Array, width: int) -> np.ndarray:
    """Features x rows."""
    data = b"".join(column.to_pylist())
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(-1, width).T)


def node_rows(model: int, rounds, first: np.ndarray, feats: list[str], edges) -> pd.DataFrame:
    """The table of a model's trees; tree -1 holds the scores to start from."""
    rows = [(model, -1, k, 1, None, None, float(v), 0.0, 0.0) for k, v in enumerate(first)]
    for t, trees in enumerate(rounds):
        for k, tree in enumerate(trees):
            for node, f, cut, value, gain, weight in tree.rows():
                name = feats[f] if f >= 0 else None
                rows.append((model, t, k, node, name, float(edges[name][cut]) if name else None, value, gain, weight))
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in NODES.split(", ")])
    return frame.astype({"tree": np.int32, "output": np.int32, "node": np.int32, "threshold": float})


def fit_in_tasks(table: DataFrame, feats: list[str], edges, settings: Callable[[int], Settings], size: int, models: int) -> DataFrame:
    """Nodes of the models of `table`, each model's rows streamed to one task."""
    width = len(feats)

    def grown(model: int, held: list[pa.RecordBatch]) -> pd.DataFrame:
        bins = np.concatenate([unpacked(b.column("bins"), width) for b in held], 1)
        y = np.concatenate([b.column("y").to_numpy() for b in held])
        # sums follow the order of rows: one order, whatever the shuffle gave
        order = np.lexsort((*bins, y))
        first, rounds = histograms.fit(np.ascontiguousarray(bins[:, order]), y[order], settings(model), size)
        return node_rows(model, rounds, first, feats, edges)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("model", pa.int64()), ("tree", pa.int32()), ("output", pa.int32()), ("node", pa.int32()), ("feature", pa.string()), ("threshold", pa.float64()), ("value", pa.float64()), ("gain", pa.float64()), ("weight", pa.float64())])
        now, held = None, []
        for batch in batches:
            codes = batch.column("model").to_numpy()
            ends = [*(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
            at = 0
            for end in ends:
                if end == at:
                    continue
                if held and codes[at] != now:
                    yield pa.RecordBatch.from_pandas(grown(now, held), schema, preserve_index=False)
                    held = []
                now = int(codes[at])
                held.append(batch.slice(at, end - at))
                at = end
        if held:
            yield pa.RecordBatch.from_pandas(grown(now, held), schema, preserve_index=False)

    parts = max(1, min(models, cpu_tasks(table.sparkSession)))
    dealt = table.repartitionById(parts, F.pmod("model", F.lit(parts)).cast("int")).sortWithinPartitions("model")
    return dealt.mapInArrow(work, NODES)


def fit_by_level(table: DataFrame, feats: list[str], edges, settings: Callable[[int], Settings], size: int, sums: dict[int, np.ndarray]) -> list[DataFrame]:
    """Nodes of the models of `table`, one job a level of a tree of all of them; `sums` has what `start` takes, by model.

    The rows are blocks of arrays with their scores so far, cached over the jobs of a tree; the first job of the next
    one adds the tree to the scores. Jobs return the sums of one child of each pair. Should the sums of all tasks be
    too many for the driver, they are added up by model first.
    """
    spark, width = table.sparkSession, len(feats)
    of = {m: settings(m) for m in sums}
    first = {m: histograms.start(w[:-1], w[-1], of[m].classes) for m, w in sums.items()}

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a task in blocks by model."""
        held: dict[int, list] = {}
        for batch in batches:
            codes, y, bins = batch.column("model").to_numpy(), batch.column("y").to_numpy(), unpacked(batch.column("bins"), width)
            for model in np.unique(codes).tolist():
                own = codes == model
                parts = held.setdefault(model, [])
                parts.append((y[own], bins[:, own]))
                if sum(len(p[0]) for p in parts) >= histograms.BLOCK_ROWS:
                    yield whole(model, held.pop(model))
        for model, parts in held.items():
            yield whole(model, parts)

    def whole(model: int, parts: list) -> pa.RecordBatch:
        y, bins = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts], 1)
        return pa.RecordBatch.from_arrays([pa.array([model]), pa.array([y.tobytes()]), pa.array([bins.tobytes()])], ["model", "y", "bins"])

    def opened(row) -> tuple:
        y = np.frombuffer(row["y"])
        return row["model"], y, np.frombuffer(row["bins"], np.uint8).reshape(width, -1), np.repeat(first[row["model"]][:, None], len(y), 1)

    def advance(trees: dict[int, list[Tree]]):
        def work(block: tuple) -> tuple:
            model, y, bins, raw = block
            raw = raw.copy()
            for k, tree in enumerate(trees.get(model, [])):
                raw[k] += tree.value.take(tree.route(bins, np.ones(len(y), np.int64), of[model].depth))
            return model, y, bins, raw

        return work

    def level_sums(trees: dict[int, list[Tree]], level: int, asked: dict[tuple[int, int], np.ndarray]):
        """Sums of each task by (model, output): an array over the asked nodes, features, bins and (h, g)."""

        def work(blocks: Iterator[tuple]):
            total: dict[tuple[int, int], np.ndarray] = {}
            for model, y, bins, raw in blocks:
                wanted = [k for m, k in asked if m == model]
                if not wanted:
                    continue
                g, h = histograms.slopes(y, raw, of[model].classes)
                for k in wanted:
                    nodes = asked[model, k]
                    node = trees[model][k].route(bins, np.ones(len(y), np.int64), level)
                    hist = histograms.histogram(bins, histograms.slots_of(node, nodes, level), g[k], h[k], len(nodes), size)
                    total[model, k] = total.get((model, k), 0) + hist
            return iter(total.items())

        return work

    tasks = 2 * spark.sparkContext.defaultParallelism
    shared_dir(spark)  # names the folder of checkpoints
    blocks = pin(table.mapInArrow(packed, "model long, y binary, bins binary").repartition(tasks))
    state = blocks.rdd.map(opened).coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK)
    rounds: dict[int, list] = {m: [] for m in of}
    written = None
    for t in range(max(s.iters for s in of.values())):
        before = state
        if t:
            state = before.map(advance({m: r[-1] for m, r in rounds.items() if len(r) == t})).persist(StorageLevel.MEMORY_AND_DISK)
            if t % KEPT_TREES == 0:
                state.checkpoint()  # after the next job: a lost executor costs no more than these trees
        live = [m for m in of if t < of[m].iters]
        trees = {m: [Tree(of[m].depth) for _ in range(max(1, of[m].classes))] for m in live}
        nodes = {(m, k): np.array([1]) for m in live for k in range(len(trees[m]))}
        asked, parents, level = dict(nodes), {}, 0
        while asked:
            parts = state.mapPartitions(level_sums(trees, level, asked))
            if sum(map(len, asked.values())) * width * size * 16 * parts.getNumPartitions() > GATHERED_BYTES:
                parts = parts.reduceByKey(np.add, min(len(asked), parts.getNumPartitions()))
            summed: dict[tuple[int, int], np.ndarray] = {}
            for key, hist in parts.collect():
                summed[key] = summed.get(key, 0) + hist
            if level == 0 and t:
                before.unpersist()
            if level == 0 and state.isCheckpointed():
                drop_folder(spark, written)
                written = state.getCheckpointFile()
            after, smaller, own = {}, {}, {}
            for (m, k), hist in summed.items():
                hist = histograms.with_siblings(hist, asked[m, k], parents.get((m, k)))
                found = histograms.best_splits(hist, of[m])
                opens = trees[m][k].split(nodes[m, k], found, of[m])
                if len(opens) and level + 1 < of[m].depth:
                    after[m, k], smaller[m, k], own[m, k] = opens, trees[m][k].smaller(opens), hist[found["feature"] >= 0]
            nodes, asked, parents, level = after, smaller, own, level + 1
        for m in live:
            rounds[m].append(trees[m])
    state.unpersist()
    drop_folder(spark, written)
    unpin(blocks)
    return [spark.createDataFrame(node_rows(m, r, first[m], feats, edges), NODES) for m, r in rounds.items()]


def fit_models(
    rows: DataFrame, feats: list[str], label: str, models: str | None = None, settings: Settings | dict[int, Settings] = Settings(), bins: int = BINS, task_rows: int = TASK_ROWS
) -> DataFrame:
    """The nodes of every model, written: see `NODES`; a row of `tree` -1 has the score to start from.

    `models` names an array column with the numbers of the models that a row trains; without it all rows train model 0.
    Rows without a label are left out; without any row there are no nodes. Equal rows in another order give the same
    trees up to rounding. `settings` may differ by model.
    """
    if models is None:
        rows, models = rows.withColumn("_models", F.array(F.lit(0).cast("long"))), "_models"
    rows = rows.where(F.col(label).isNotNull())
    edges = bin_edges(rows, feats, bins)
    table = pin(binned_rows(rows, feats, label, models, edges))
    given = (lambda m: settings[m]) if isinstance(settings, dict) else (lambda m: settings)
    counts = table.groupBy("model").agg(F.count("*").alias("n"))
    large = sorted(r[0] for r in counts.where(F.col("n") > task_rows).select("model").collect())  # at most rows / task_rows
    total = counts.count()
    parts = []
    if total > len(large):
        small = table.where(~F.col("model").isin(large)) if large else table
        parts.append(fit_in_tasks(small, feats, edges, given, bins, total))
    if large:
        own = table.where(F.col("model").isin(large))
        parts += fit_by_level(own, feats, edges, given, bins, label_sums(own, given, large))
    out = parts[0] if parts else rows.sparkSession.createDataFrame([], NODES)
    for part in parts[1:]:
        out = out.unionByName(part)
    out = pin(out)
    unpin(table)
    return out


def label_sums(table: DataFrame, settings: Callable[[int], Settings], models: list[int]) -> dict[int, np.ndarray]:
    """By model the number of rows (of each class, if it has any) and, at the end, the sum of the labels."""
    classes = max(settings(m).classes for m in models)
    each = [F.count_if(F.col("y") == k).cast("double") for k in range(classes)]
    found = table.groupBy("model").agg(F.count("*").cast("double").alias("n"), F.sum("y").alias("s"), F.array(*each).alias("c") if each else F.array(F.lit(0.0)).alias("c")).collect()
    return {r["model"]: np.array([*(r["c"][: settings(r["model"]).classes] if settings(r["model"]).classes else [r["n"]]), r["s"]]) for r in found}


def forest(nodes: pd.DataFrame, feats: list[str]) -> dict[int, list]:
    """By model (start scores, and for each output the arrays of its trees: feature, threshold, value)."""
    place = {f: k for k, f in enumerate(feats)}
    out = {}
    for model, own in nodes.groupby("model"):
        trees = own[own["tree"] >= 0]
        base = own[own["tree"] < 0].sort_values("output")["value"].to_numpy()
        shape = (int(trees["tree"].max()) + 1 if len(trees) else 0, int(own["node"].max()) + 1)
        made = []
        for k in range(len(base)):
            part = trees[trees["output"] == k]
            feature, threshold, value = np.full(shape, -1, np.int16), np.zeros(shape), np.zeros(shape)
            at = part["tree"].to_numpy(), part["node"].to_numpy()
            feature[at] = part["feature"].map(place).fillna(-1).to_numpy(np.int16)
            threshold[at], value[at] = part["threshold"].fillna(0.0), part["value"]
            made.append((feature, threshold, value))
        out[int(model)] = [base, made]
    return out


def raw_scores(x: np.ndarray, base: np.ndarray, outputs: list) -> np.ndarray:
    """Outputs x rows: the start score and, of every tree, the value of the leaf that a row ends in."""
    raw = np.repeat(base[:, None], len(x), 1)
    flat, width = np.ascontiguousarray(x).ravel(), x.shape[1]
    starts = [np.arange(a, min(a + histograms.ROUTED_ROWS, len(x))) * width for a in range(0, len(x), histograms.ROUTED_ROWS)]
    for k, (feature, threshold, value) in enumerate(outputs):
        place = np.arange(feature.shape[1])
        for f, cut, leaf in zip(feature, threshold, value):
            # a leaf leads to itself, as nothing exceeds its cut
            inner = f >= 0
            column, cut, left = np.where(inner, f, 0).astype(np.int64), np.where(inner, cut, np.inf), np.where(inner, 2 * place, place)
            levels = int(place[inner].max()).bit_length() if inner.any() else 0
            for block, start in enumerate(starts):
                node = np.ones(len(start), np.int64)
                for _ in range(levels):
                    at = column.take(node)
                    at += start
                    over = flat.take(at) > cut.take(node)
                    node = left.take(node)
                    node += over
                first = block * histograms.ROUTED_ROWS
                raw[k, first : first + len(node)] += leaf.take(node)
    return raw


def predict(nodes: DataFrame, rows: DataFrame, feats: list[str], model: Column | None = None, name: str = "predicted", classes: bool = False) -> DataFrame:
    """`rows` with the score of their model (number 0 if none is given), or with all class chances as an array.

    Rows without a model, or of a number without nodes, have NULL. Nodes go to the tasks for at most `SCORED_MODELS`
    models at a time, each of them no more than trees x nodes rows; more models are more passes over the rows.
    """
    code = F.lit(0).cast("long") if model is None else model.cast("long")
    known = [r[0] for r in nodes.select("model").distinct().orderBy("model").collect()]
    kind = T.ArrayType(T.DoubleType()) if classes else T.DoubleType()
    fields = [F.struct(*rows.columns).alias("row"), code.alias("model"), F.array(*[number(f) for f in feats]).alias("x")]
    schema = T.StructType([T.StructField("row", rows.select(F.struct(*rows.columns).alias("r")).schema["r"].dataType), T.StructField(name, kind)])

    def scored(own: dict[int, list]):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes = batch.column("model").to_numpy(zero_copy_only=False)
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                out: list = [None] * batch.num_rows
                for m, (base, outputs) in own.items():
                    at = np.flatnonzero(codes == m)
                    if len(at):
                        raw = raw_scores(x[at], base, outputs)
                        values = histograms.chances(raw).T.tolist() if classes else raw[0].tolist()
                        for i, v in zip(at.tolist(), values):
                            out[i] = v
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.list_(pa.float64()) if classes else pa.float64())], ["row", name])

        return work

    plain = rows.select(*fields)
    blocks = [known[k : k + SCORED_MODELS] for k in range(0, len(known), SCORED_MODELS)] or [[]]
    out = None
    for k, block in enumerate(blocks):
        own = forest(nodes.where(F.col("model").between(block[0], block[-1])).toPandas(), feats) if block else {}
        mine = plain
        if len(blocks) > 1:
            low, high = block[0], blocks[k + 1][0] if k + 1 < len(blocks) else None
            inside = (F.col("model") >= low if k else F.lit(True)) & (F.col("model") < high if high is not None else F.lit(True))
            mine = plain.where(F.coalesce(inside, F.lit(k == 0)))
        part = mine.mapInArrow(scored(own), schema)
        out = part if out is None else out.unionAll(part)
    return out.select("row.*", name)


def importance(nodes: DataFrame, feats: list[str]) -> DataFrame:
    """The share of each feature in the gains of model 0's nodes; features without a split have 0."""
    spark = nodes.sparkSession
    gains = nodes.where((F.col("model") == 0) & F.col("feature").isNotNull()).groupBy("feature").agg(F.sum("gain").alias("_gain"))
    every = spark.createDataFrame([(f,) for f in feats], "feature string")
    total = gains.agg(F.sum("_gain").alias("_total"))
    joined = every.join(gains, "feature", "left").crossJoin(F.broadcast(total))
    share = F.coalesce(F.try_divide("_gain", "_total"), F.lit(0.0)).alias("importance")
    return joined.select("feature", share).orderBy(F.desc("importance"), "feature")


def first_splits(nodes: DataFrame) -> DataFrame:
    """(model, feature, threshold, gain, n_rows) of every model's first root."""
    root = nodes.where((F.col("tree") == 0) & (F.col("output") == 0) & (F.col("node") == 1))
    return root.select("model", "feature", "threshold", "gain", F.col("weight").cast("long").alias("n_rows"))
