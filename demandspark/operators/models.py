"""Trained models (M01-M18): histogram boosting for pooled fits, moment tables for linear ones, grouped maps per series."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import calendar_flags, cyclical, week_num, week_start, year_week
from ..functions.clean import SEGMENT_CODES, BUYER_CODES, ordinal, safe_div
from ..functions.distributed import key_join, number_rows
from ..session import cpu_tasks, pin
from . import boosting, moments, series_models
from .baselines import normal_quantile
from .boosting import importance  # noqa: F401  M14, beside the other models
from .evaluate import errors, wmape
from .histograms import Settings
from .joins import eligible, top_entities
from .quality import outliers_iqr, winsorise
from .series_models import arima_each, boost, level_steps, matrix, on_weeks, ridge_each, same_key
from .windows import frame, lags, ordered

GLOBAL_FEATURES = ["lag1", "lag2", "lag4", "rolling_avg_4w", "avg_unit_price", "week_num", "is_w47"]
MOST_CLASSES = 64
FIT_ROWS = 1 << 16  # rows of a batch of small fits: many series side by side, a few dozen MB

# the numpy fits travel with the task, so executors need no copy of this package
register_pickle_by_value(series_models)


def model_features(df: DataFrame, e: list[str], y: str = "weekly_quantity") -> DataFrame:
    """The features of M01-M05: every window column excludes the current row."""
    w = ordered(e)
    four = frame(e, "year_week", 4)
    price = F.col("avg_unit_price")
    mean, std = F.avg(y).over(four), F.stddev_samp(y).over(four)
    out = df.withColumns(
        {
            "week_num": week_num("year_week"),
            "lag1": F.lag(y, 1).over(w),
            "lag2": F.lag(y, 2).over(w),
            "lag4": F.lag(y, 4).over(w),
            "rolling_avg_4w": mean,
            "rolling_std_4w": std,
            "rolling_min_4w": F.min(y).over(four),
            "rolling_max_4w": F.max(y).over(four),
            "price_change_pct": safe_div(price - F.lag(price, 1).over(w), F.lag(price, 1).over(w)) * 100,
            "cv_4w": F.least(F.greatest(safe_div(std, mean), F.lit(0.0)), F.lit(10.0)),
        }
    )
    return cyclical(calendar_flags(out, "week_num", "v4"))


def zero_filled(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols})


def fit(df: DataFrame, feats: list[str], label: str, core: list[str] | None = None, **settings) -> DataFrame:
    """Boosted trees on all rows with a label, as a table of nodes; `settings` are those of `Settings`."""
    return boosting.fit_models(complete_rows(df, core), feats, label, settings=Settings(**settings))


def score(model: DataFrame, df: DataFrame, feats: list[str], floor: bool = True) -> DataFrame:
    """Predictions for any rows, also a single what-if row."""
    scored = boosting.predict(model, df, feats)
    return scored.withColumn("predicted", F.greatest("predicted", F.lit(0.0))) if floor else scored


def result(scored: DataFrame, e: list[str], label: str, model_type: str) -> DataFrame:
    return scored.select(
        *e, "year_week", "predicted", F.col(label).cast("double").alias("actual"), F.lit(model_type).alias("model_type")
    )


def gbt_global(
    train: DataFrame, test: DataFrame, e: list[str], feats: list[str], label: str, core: list[str] | None = None, **params
) -> DataFrame:
    """One boosted-tree model over all entities; with `core`, on rows that have all these features."""
    return result(score(fit(train, feats, label, core, **params), complete_rows(test, core), feats), e, label, "global")


def grouped(train: DataFrame, group: str, min_rows: int = 50) -> DataFrame:
    """(group, model): numbers from 1 on for the groups with at least `min_rows` training rows, in the groups' order."""
    counts = train.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("_n")).where(F.col("_n") >= min_rows)
    return number_rows(counts.select(group), [group], "model")


def group_training_rows(train: DataFrame, group: str, core: list[str] | None = None, min_rows: int = 50) -> DataFrame:
    """Per group its complete training rows and whether they are enough for a model of its own."""
    counts = complete_rows(train, core).groupBy(group).agg(F.count("*").alias("n_rows"))
    return counts.withColumn("own_model", F.col(group).isNotNull() & (F.col("n_rows") >= min_rows))


def group_models(train: DataFrame, group: str, codes: DataFrame, feats: list[str], label: str, **params) -> DataFrame:
    """Nodes of the global model, number 0, and of each group with a number in `codes`, all from the same jobs."""
    coded = key_join(train, codes, [group], "left")
    both = F.when(F.col("model").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.array(F.lit(0).cast("long"), F.col("model")))
    return boosting.fit_models(coded.withColumn("_models", both), feats, label, "_models", Settings(**params))


def gbt_by_group(
    train: DataFrame, test: DataFrame, e: list[str], group: str, feats: list[str], label: str, min_rows: int = 50, core: list[str] | None = None, **params
) -> DataFrame:
    """A model per group of at least `min_rows` complete rows; other groups take the global model.

    A row trains the global model and its group's; the number of jobs does not depend on the number of groups.
    """
    train, test = complete_rows(train, core), complete_rows(test, core)
    codes = pin(grouped(train, group, min_rows))
    nodes = group_models(train, group, codes, feats, label, **params)
    coded = key_join(test, codes, [group], "left").withColumn("model_type", F.when(F.col("model").isNull(), "global").otherwise("category"))
    scored = boosting.predict(nodes, coded, feats, F.coalesce("model", F.lit(0)))
    floored = F.greatest("predicted", F.lit(0.0)).alias("predicted")
    return scored.select(*e, "year_week", floored, F.col(label).cast("double").alias("actual"), "model_type")


def complete_rows(df: DataFrame, core: list[str] | None) -> DataFrame:
    """Rows without a NULL in the core features; without a list all rows, whose NULLs then count as zero."""
    return df.dropna(subset=core) if core else df


def training_rows(train: DataFrame, e: list[str], core: list[str], min_rows: int = 4) -> DataFrame:
    """Per entity its training rows, the complete ones, and whether they are enough for a model of its own."""
    complete = F.count_if(reduce(Column.__and__, (F.col(c).isNotNull() for c in core)))
    counts = train.groupBy(*e).agg(F.count("*").alias("n_rows"), complete.alias("n_complete"))
    return counts.withColumn("eligible", F.col("n_complete") >= min_rows)


def entity_frame(
    train: DataFrame, test: DataFrame, e: list[str], feats: list[str], label: str, extra=(), core: list[str] | None = None
) -> DataFrame:
    """Training and test rows of each entity side by side, with the entity's number of training rows.

    With `core`, rows that lack one of these features are neither fitted, counted nor scored; other NULLs are zero.
    """
    cols = [*e, "year_week", *feats, F.col(label).cast("double").alias("_y"), *extra]
    train, test = complete_rows(train, core), complete_rows(test, core)
    rows = train.select(*cols, F.lit(True).alias("_train")).unionByName(test.select(*cols, F.lit(False).alias("_train")))
    return zero_filled(rows, feats).withColumn("_n", F.count_if("_train").over(Window.partitionBy(*e)))


def per_series(rows: DataFrame, e: list[str], t: str, work, schema: T.StructType, least_rows: int = 0) -> DataFrame:
    """`work` on batches of whole series, each batch sorted by entity and `t`.

    Entities are spread by hash over a fixed number of tasks and sorted, so a task reads a
    stream of whole series; only a series cut by a batch border is held back, and batches until they have `least_rows`.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < least_rows:
                continue
            batch = pd.concat(held, ignore_index=True)
            unfinished = same_key(batch[e], batch[e].iloc[-1])
            held, whole = [batch[unfinished]], batch[~unfinished]
            if len(whole):
                yield work(whole.reset_index(drop=True))
        if sum(map(len, held)):
            yield work(pd.concat(held, ignore_index=True))

    spread = rows.repartition(cpu_tasks(rows.sparkSession), *e)
    return spread.sortWithinPartitions(*e, t).mapInPandas(run, schema)


def fit_each(rows: DataFrame, e: list[str], feats: list[str], predict) -> DataFrame:
    """One small fit per entity; `predict(series, x, y, train, rows)` scores many entities at once."""
    schema = T.StructType(
        [rows.schema[c] for c in e]
        + [
            T.StructField("year_week", T.StringType()),
            T.StructField("predicted", T.DoubleType()),
            T.StructField("actual", T.DoubleType()),
        ]
    )

    def work(batch: pd.DataFrame) -> pd.DataFrame:
        series = batch.groupby(e, sort=False, dropna=False).ngroup().to_numpy()
        train = batch["_train"].to_numpy(bool)
        values = predict(series, matrix(batch, feats), batch["_y"].to_numpy(float), train, batch)
        out = batch[[*e, "year_week"]].copy()
        out["predicted"] = values.clip(min=0).round(1)
        out["actual"] = batch["_y"]
        return out[~train]

    return per_series(rows, e, "year_week", work, schema, FIT_ROWS)


def gbt_by_entity(
    train: DataFrame,
    test: DataFrame,
    e: list[str],
    feats: list[str],
    label: str,
    min_rows: int = 4,
    trees: int = 100,
    depth: int = 5,
    step: float = 0.1,
    global_iters: int = 100,
    model_type: str = "sku",
    core: list[str] | None = None,
) -> DataFrame:
    """Boosted trees per entity with at least `min_rows` training rows, the global model for the rest.

    With `core`, only rows that have all these features count, train and are scored. Rows are one per entity and week, so a series never outgrows the calendar.
    """

    def predict(series, x, y, trained, _):
        return boost(series, x, y, trained, trees, depth, step, min_split=5)

    rows = pin(entity_frame(train, test, e, feats, label, core=core))
    own = fit_each(rows.where(F.col("_n") >= min_rows), e, feats, predict)
    rest = rows.where((F.col("_n") < min_rows) & ~F.col("_train"))
    if rest.isEmpty():
        return own.withColumn("model_type", F.lit(model_type))
    fallback = fit(rows.where("_train"), feats, "_y", depth=depth, iters=global_iters, step=step)
    pooled = result(score(fallback, rest, feats), e, "_y", "global").withColumn("predicted", F.round("predicted", 1))
    return own.withColumn("model_type", F.lit(model_type)).unionByName(pooled)


def winsorised_by_entity(train: DataFrame, test: DataFrame, e: list[str], feats: list[str], label: str, **params) -> DataFrame:
    """Boosted trees per entity, fitted to the label clipped to its quartile fences and scored on the raw one."""
    clipped = winsorise(train, e, label, name="_clipped").withColumn(label, F.col("_clipped")).drop("_clipped")
    return gbt_by_entity(clipped, test, e, feats, label, **params)


def by_pattern(
    train: DataFrame, test: DataFrame, e: list[str], feats: list[str], label: str, patterns: DataFrame, trees: int = 100
) -> DataFrame:
    """Sparse series by ridge, volatile ones by shallow subsampled trees, stable ones by standard trees."""

    def predict(series, x, y, trained, rows):
        kind = rows["pattern"].to_numpy()
        out = np.zeros(len(y))
        for name in ("sparse", "volatile", "stable"):
            own = kind == name
            if not own.any():
                continue
            codes = np.unique(series[own], return_inverse=True)[1]
            part = (codes, x[own], y[own], trained[own])
            if name == "sparse":
                out[own] = ridge_each(*part)
            elif name == "volatile":
                names = rows.loc[own, e].astype(str).agg("\x1f".join, axis=1)
                seeds = np.array([zlib.crc32(name.encode()) for name in names[~pd.Series(codes, index=names.index).duplicated()]])
                firsts = codes[~pd.Series(codes).duplicated()]
                out[own] = boost(*part, trees, 4, 0.1, 3, 0.8, min_split=5, seeds=seeds[np.argsort(firsts)])
            else:
                out[own] = boost(*part, trees, 5, 0.1, 2, min_split=5)
        return out

    kinds = patterns.select(*e, "pattern")
    rows = entity_frame(train.join(kinds, e), test.join(kinds, e), e, feats, label, extra=("pattern",))
    return fit_each(rows, e, feats, predict).join(kinds.withColumnRenamed("pattern", "model_type"), e)


def gbt_cyclical(train: DataFrame, test: DataFrame, e: list[str], feats: list[str], label: str, patterns: DataFrame, **params) -> DataFrame:
    """One model trained and scored on the cyclical entities only."""
    keys = patterns.where((F.col("pattern") == "cyclical") & (F.col("data_sufficiency") != "insufficient")).select(*e)
    out = gbt_global(train.join(keys, e, "left_semi"), test.join(keys, e, "left_semi"), e, feats, label, **params)
    return out.withColumn("model_type", F.lit("V2_cyclical"))


def linear(train: DataFrame, test: DataFrame, e: list[str], feats: list[str], label: str, l2: float = 0.1, core: list[str] | None = None) -> DataFrame:
    """Ridge regression of all rows, solved from one table of moments."""
    sums = moments.moments(zero_filled(complete_rows(train, core), feats), feats, label)
    scored = moments.predict(moments.ridge(sums, feats, l2), zero_filled(complete_rows(test, core), feats), feats)
    return result(scored.withColumn("predicted", F.greatest("predicted", F.lit(0.0))), e, label, "linear")


def arima_eligible(df: DataFrame, e: list[str], y: str, min_weeks: int = 20, top: int | None = None, weeks: DataFrame | None = None) -> DataFrame:
    """Series long enough, among the largest `top`, on complete weeks only."""
    rows = df
    if weeks is not None:
        rows = rows.join(weeks.where(F.col("data_completeness") == "complete").select("year_week"), "year_week", "left_semi")
    rows = eligible(rows, e, min_weeks)
    return rows if top is None else top_entities(rows, e, y, top)


def auto_arima(
    df: DataFrame,
    e: list[str],
    y: str,
    h: int = 4,
    level: float = 0.8,
    min_weeks: int = 20,
    clean_spikes: bool = True,
    adjust_steps: bool = True,
    holiday_weeks: tuple[int, ...] = (),
    max_p: int = 3,
    max_q: int = 2,
) -> DataFrame:
    """The next h weeks of each eligible series, with intervals.

    Each series has its exact Gaussian likelihood maximised over ARMA orders up to (`max_p`, `max_q`), with and without a
    yearly wave, by a Kalman filter in which missing weeks stay missing; one difference by a unit-root test. Before the
    fit, spikes and holiday weeks (ISO week numbers) take the series median and an earlier level is moved to the latest
    one; a forecast holiday week is scaled by the holiday weeks' mean over the median.
    """
    rows = eligible(df.where(F.col(y).isNotNull()), e, min_weeks)
    whole = Window.partitionBy(*e)
    is_holiday = week_num("year_week").isin(*holiday_weeks) if holiday_weeks else F.lit(False)
    effects = None
    if clean_spikes or holiday_weeks:
        flagged = outliers_iqr(rows, e, y, 3.0).withColumn("_median", F.percentile(y, 0.5).over(whole))
        if holiday_weeks:
            ratio = safe_div(F.avg(F.when(is_holiday, F.col(y))), F.max("_median"))
            effects = flagged.groupBy(*e).agg(F.coalesce(ratio, F.lit(1.0)).alias("_effect"))
        spike = (F.col("is_outlier") == 1) if clean_spikes else F.lit(False)
        rows = flagged.withColumn(y, F.when(spike | is_holiday, F.col("_median")).otherwise(F.col(y)))
    grid = rows.select(*e, week_start("year_week").alias("week_start"), F.col(y).cast("double").alias("_y"))
    schema = T.StructType(
        [grid.schema[c] for c in e]
        + [
            T.StructField("last_week", T.DateType()),
            T.StructField("step", T.IntegerType()),
            T.StructField("forecast", T.DoubleType()),
            T.StructField("standard_error", T.DoubleType()),
            T.StructField("model_order", T.StringType()),
        ]
    )

    def work(batch: pd.DataFrame) -> pd.DataFrame:
        ends = np.flatnonzero(np.append(~same_key(batch[e].iloc[:-1].reset_index(drop=True), batch[e].iloc[1:].reset_index(drop=True)), True)) + 1
        values = np.split(batch["_y"].to_numpy(float), ends[:-1])
        weeks = np.split(pd.to_datetime(batch["week_start"]).to_numpy().astype("datetime64[D]").astype(np.int64) // 7, ends[:-1])
        fits = arima_each([on_weeks(w - w[0], level_steps(y) if adjust_steps else y) for w, y in zip(weeks, values)], h, max_p, max_q)
        out = batch.loc[np.repeat(ends - 1, h), [*e, "week_start"]].rename(columns={"week_start": "last_week"})
        out["step"] = np.tile(np.arange(1, h + 1, dtype=np.int32), len(fits))
        out["forecast"] = np.concatenate([f[0] for f in fits]).clip(min=0)
        out["standard_error"] = np.concatenate([f[1] for f in fits])
        out["model_order"] = np.repeat([f[2] for f in fits], h)
        return out

    reach = F.col("standard_error") * normal_quantile(level)
    ahead = per_series(grid, e, "week_start", work, schema)
    ahead = ahead.withColumn("year_week", year_week(F.date_add("last_week", F.col("step") * 7))).drop("last_week")
    if effects is not None:
        factor = F.when(is_holiday, F.col("_effect")).otherwise(1.0)
        ahead = ahead.join(effects, e).withColumns(
            {"forecast": F.col("forecast") * factor, "standard_error": F.col("standard_error") * factor}
        ).drop("_effect")
    return ahead.withColumns(
        {"lower_bound": F.greatest(F.col("forecast") - reach, F.lit(0.0)), "upper_bound": F.col("forecast") + reach}
    )


def segment_features(weekly: DataFrame) -> DataFrame:
    """Segment and buyer codes, week of year and month of a sku-customer week."""
    return weekly.where((F.col("weekly_quantity") > 0) & F.col("customer_segment").isNotNull()).withColumns(
        {
            "segment_code": ordinal("customer_segment", SEGMENT_CODES),
            "buyer_type_code": ordinal("buyer_type", BUYER_CODES),
            "week_of_year": week_num("year_week"),
            "month": F.month(week_start("year_week")),
        }
    )


def segment_series(weekly: DataFrame, segments: list[str], min_weeks: int = 1) -> DataFrame:
    """Customer-week demand of the listed segments, for customers with enough weeks."""
    rows = weekly.where(F.col("customer_segment").isin(*segments) & (F.col("weekly_quantity") > 0))
    series = rows.groupBy("customer_id", "year_week").agg(F.sum("weekly_quantity").alias("weekly_quantity"))
    return eligible(series, ["customer_id"], min_weeks)


def held_out(key: Column | str, every: int = 5) -> Column:
    """A fifth of the keys, by a hash that does not depend on the run."""
    return F.pmod(F.xxhash64(F.col(key) if isinstance(key, str) else key), F.lit(every)) == 0


def cycle_classifier(dim: DataFrame, feats: list[str], label: str = "cycle_regularity", rounds: int = 50, depth: int = 5, step: float = 0.1) -> DataFrame:
    """Predicted order rhythm and its class probabilities, customers with at least two orders.

    One model of all classes: each round grows a tree of every class on the gradients of their joint softmax. It is
    fitted without the held-out fifth of the customers, and only those are scored. At most `MOST_CLASSES` labels.
    """
    rows = dim.where((F.col("total_orders") >= 2) & F.col(label).isNotNull())
    names = [r[0] for r in rows.select(label).distinct().orderBy(label).limit(MOST_CLASSES + 1).collect()]
    if len(names) > MOST_CLASSES:
        raise ValueError(f"{label} has more than {MOST_CLASSES} values")
    labels = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    rows = rows.withColumn("_class", F.array_position(labels, F.col(label)) - 1)
    settings = Settings(rounds, depth, step, min_leaf=1.0, min_split=0.0, l2=1.0, classes=len(names))
    model = boosting.fit_models(rows.where(~held_out("customer_id")), feats, "_class", settings=settings)
    scored = boosting.predict(model, rows.where(held_out("customer_id")), feats, name="_chances", classes=True)
    said = F.element_at(labels, F.array_position("_chances", F.array_max("_chances")).cast("int"))
    return scored.select("customer_id", F.col(label).alias("actual_label"), said.alias("predicted_label"), F.map_from_arrays(labels, "_chances").alias("class_probs"))


def elasticity_features(history: DataFrame, min_pct: float = 0.1) -> DataFrame:
    """Price moves over `min_pct` percent and the quantity change beside them."""
    w = ordered(["sku"])
    rows = history.withColumn("prev_avg_price", F.lag("avg_price").over(w)).where(F.col("prev_avg_price") > 0)
    rows = rows.withColumns(
        {
            "price_change_pct": safe_div(F.col("avg_price") - F.col("prev_avg_price"), "prev_avg_price") * 100,
            "prev_quantity": F.lag("weekly_quantity").over(w),
        }
    )
    moved = rows.where((F.col("prev_quantity") > 0) & (F.abs("price_change_pct") > min_pct))
    change = safe_div(F.col("weekly_quantity") - F.col("prev_quantity"), "prev_quantity") * 100
    return moved.select(
        "sku", "year_week", "price_change_pct", "avg_price", "prev_avg_price", "weekly_quantity", "prev_quantity",
        change.alias("quantity_change_pct"),
    )


def log_elasticity(history: DataFrame, min_rows: int = 8) -> DataFrame:
    """Exact log-log slope of quantity on price per sku."""
    rows = history.where((F.col("avg_price") > 0) & (F.col("weekly_quantity") > 0))
    return (
        rows.groupBy("sku")
        .agg(
            F.regr_slope(F.log("weekly_quantity"), F.log("avg_price")).alias("elasticity"),
            F.count("*").alias("n_weeks"),
        )
        .where(F.col("n_weeks") >= min_rows)
    )


def encode(df: DataFrame, fit_on: DataFrame, col: str, name: str | None = None, unseen: int = -1) -> DataFrame:
    """Code of each value in the sorted distinct values of `fit_on`; unseen values get -1.

    The values are numbered by a range sort, not gathered on the driver.
    """
    name = name or f"{col}_encoded"
    codes = number_rows(fit_on.select(col).where(F.col(col).isNotNull()).distinct(), [col], name, 0)
    return key_join(df, codes, [col], "left").withColumn(name, F.coalesce(name, F.lit(unseen)))


def sku_revenue_features(df: DataFrame, e: str = "sku") -> DataFrame:
    """Lags 1-4, rolling mean and deviation of revenue, lagged quantity and orders; full rows only."""
    w, four = ordered([e]), frame([e], "year_week", 4)
    start = week_start("year_week")
    rows = lags(df, [e], "year_week", "revenue", (1, 2, 3, 4), "revenue_lag_").withColumns(
        {
            "week_of_year": week_num("year_week"),
            "month": F.month(start),
            "quarter": F.quarter(start),
            "revenue_rolling_mean_4": F.avg("revenue").over(four),
            "revenue_rolling_std_4": F.stddev_samp("revenue").over(four),
            "quantity_lag_1": F.lag("quantity").over(w),
            "orders_lag_1": F.lag("num_orders").over(w),
        }
    )
    return rows.dropna()


def ts_splits(df: DataFrame, splits: int = 3) -> DataFrame:
    """(fold, role, year_week) of expanding splits; the week list is as short as the calendar."""
    weeks = df.select("year_week").distinct()
    numbered = weeks.withColumns(
        {
            "_i": F.row_number().over(Window.orderBy("year_week")) - 1,
            "_n": F.count("*").over(Window.partitionBy()),
        }
    )
    size = F.floor(F.col("_n") / (splits + 1))
    folds = numbered.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(splits))))
    first = F.col("_n") - (splits - F.col("fold") + 1) * size
    role = F.when(F.col("_i") < first, "train").when(F.col("_i") < first + size, "test")
    return folds.select("fold", role.alias("role"), "year_week").where(F.col("role").isNotNull())


def cv_models(settings: list[dict], splits: int) -> dict[int, tuple[int, dict]]:
    """Number of each model of a cross-validation: its fold and setting."""
    return {k * splits + fold - 1: (fold, setting) for k, setting in enumerate(settings) for fold in range(1, splits + 1)}


def cv_frame(df: DataFrame, settings: list[dict], splits: int, core: list[str] | None) -> DataFrame:
    """The complete rows with the numbers of the models that they train and that they test."""
    rows = complete_rows(df, core)
    weeks = ts_splits(rows, splits).groupBy("year_week").agg(*[F.collect_set(F.when(F.col("role") == r, F.col("fold"))).alias(f"_{r}") for r in ("train", "test")])
    models_of = lambda folds: F.flatten(F.transform(folds, lambda f: F.array(*[(f + (k * splits - 1)).cast("long") for k in range(len(settings))])))
    marked = rows.join(F.broadcast(weeks), "year_week")  # a row a week
    return marked.withColumns({f"_{r}": models_of(f"_{r}") for r in ("train", "test")})


def cv_table(spark, settings: list[dict], splits: int) -> DataFrame:
    kinds = ", ".join(f"{n} {'double' if isinstance(v, float) else 'int'}" for n, v in settings[0].items())
    listed = [(m, fold, *setting.values()) for m, (fold, setting) in cv_models(settings, splits).items()]
    return spark.createDataFrame(listed, f"_model long, fold int, {kinds}")


def cv_rows(df: DataFrame, settings: list[dict], splits: int = 3, core: list[str] | None = None) -> DataFrame:
    """Of every setting and fold how many rows train and test it."""
    marked = cv_frame(df, settings, splits, core)
    counts = [marked.select(F.explode(f"_{r}").alias("_model")).groupBy("_model").agg(F.count("*").alias(f"n_{r}")) for r in ("train", "test")]
    counts = counts[0].join(counts[1], "_model", "full").fillna(0)
    return cv_table(df.sparkSession, settings, splits).join(counts, "_model").drop("_model")


def ts_cv(df: DataFrame, e: list[str], feats: list[str], label: str, settings: list[dict], splits: int = 3, core: list[str] | None = None) -> DataFrame:
    """Mean and deviation of the MAE over expanding splits, per setting of the fit.

    Each pair of a setting and a fold is a model of the same jobs: a row carries the numbers of the models that it
    trains. A fold's week list is as short as the calendar.
    """
    marked = pin(cv_frame(df.select(*dict.fromkeys([*e, "year_week", *feats, *(core or []), label])), settings, splits, core))
    own = {m: Settings(**setting) for m, (_, setting) in cv_models(settings, splits).items()}
    nodes = boosting.fit_models(marked.where(F.size("_train") > 0), feats, label, "_train", own)
    tests = marked.withColumn("_model", F.explode("_test"))
    scored = boosting.predict(nodes, tests, feats, F.col("_model")).withColumn("predicted", F.greatest("predicted", F.lit(0.0)))
    mae = scored.groupBy("_model").agg(F.avg(F.abs(F.col(label) - F.col("predicted"))).alias("mae"))
    listed = cv_table(df.sparkSession, settings, splits)
    table = mae.join(F.broadcast(listed), "_model").groupBy(*settings[0]).agg(F.avg("mae").alias("cv_mae"), F.stddev_pop("mae").alias("cv_std"))
    best = F.min("cv_mae").over(Window.partitionBy(F.lit(1)))
    return table.withColumn("is_best", F.col("cv_mae") == best)


def exclude_weeks(df: DataFrame, weeks: list[int]) -> DataFrame:
    """Training rows without the listed week numbers."""
    return df.where(~week_num("year_week").isin(*weeks))


def ensemble(preds: dict[str, DataFrame], weights: dict[str, dict[str, float]], patterns: DataFrame, e: list[str], default: str) -> DataFrame:
    """Weighted sum of models; the weights depend on the entity's pattern."""
    names = list(preds)
    out = preds[names[0]].select(*e, "year_week", "actual", F.col("predicted").alias(names[0]))
    for name in names[1:]:
        out = out.join(preds[name].select(*e, "year_week", F.col("predicted").alias(name)), [*e, "year_week"])
    out = out.join(patterns.select(*e, "pattern"), e)

    def mix(kind: str) -> Column:
        return sum((F.col(n) * float(weights[kind][n]) for n in names[1:]), F.col(names[0]) * float(weights[kind][names[0]]))

    mixed = F.lit(None).cast("double")
    for kind in weights:
        if kind != default:
            mixed = F.when(F.col("pattern") == kind, mix(kind)).otherwise(mixed)
    return out.select(*e, "year_week", "pattern", F.coalesce(mixed, mix(default)).alias("predicted"), "actual")


def model_summary(preds: DataFrame, e: list[str]) -> DataFrame:
    """Mean of the per-series MAE and MSE, and the number of series."""
    per = errors(preds).groupBy(*e).agg(
        F.avg("abs_error").alias("mae"), F.avg(F.col("error") * F.col("error")).alias("mse"),
        wmape(F.col("actual"), F.col("predicted")).alias("wmape"),
    )
    return per.agg(
        F.count("*").alias("n_series"), F.avg("mae").alias("mean_mae"), F.avg("mse").alias("mean_mse"), F.avg("wmape").alias("mean_wmape")
    )


def classifier_metrics(scored: DataFrame) -> DataFrame:
    """Accuracy, and precision, recall and F1 weighted by class size, of (actual_label, predicted_label)."""
    cells = scored.groupBy("actual_label", "predicted_label").agg(F.count("*").alias("_n"))
    hit = F.when(F.col("actual_label") == F.col("predicted_label"), F.col("_n")).otherwise(0)
    actual = cells.groupBy(F.col("actual_label").alias("label")).agg(F.sum("_n").alias("_a"), F.sum(hit).alias("_h"))
    said = cells.groupBy(F.col("predicted_label").alias("label")).agg(F.sum("_n").alias("_p"))
    per = actual.join(said, "label", "left")
    precision = F.coalesce(F.try_divide("_h", "_p"), F.lit(0.0))
    recall = F.col("_h") / F.col("_a")
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    weight = F.col("_a")
    return per.agg(
        F.sum("_a").alias("n_rows"),
        (F.sum("_h") / F.sum("_a")).alias("accuracy"),
        (F.sum(weight * precision) / F.sum(weight)).alias("precision"),
        (F.sum(weight * recall) / F.sum(weight)).alias("recall"),
        (F.sum(weight * f1) / F.sum(weight)).alias("f1_score"),
    )
