"""Stand-alone joins, top lists and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import safe_div
from ..functions.distributed import exact_percentiles
from ..sources.sheets import first_by


def match_predictions(actuals: DataFrame, preds: DataFrame, e: list[str]) -> DataFrame:
    """Actual and predicted of the same entity and week."""
    return actuals.join(preds, [*e, "year_week"], "inner")


def eligible(df: DataFrame, e: list[str], min_n: int) -> DataFrame:
    """Rows of entities with at least `min_n` rows."""
    enough = df.groupBy(*e).agg(F.count("*").alias("_n")).where(F.col("_n") >= min_n).select(*e)
    return df.join(enough, e, "left_semi")


def top_keys(df: DataFrame, e: list[str], y: str, n: int) -> DataFrame:
    """Keys of the n largest totals; ties by key."""
    return df.groupBy(*e).agg(F.sum(y).alias("_s")).orderBy(F.desc("_s"), *e).limit(n).select(*e)


def top_entities(df: DataFrame, e: list[str], y: str, n: int) -> DataFrame:
    """Rows of the n largest entities; the key list has n rows."""
    return df.join(F.broadcast(top_keys(df, e, y, n)), e, "left_semi")


def related_count(df: DataFrame, e: list[str], other: str, name: str) -> DataFrame:
    """Per entity, in how many values of another column it occurs."""
    counts = df.groupBy(*e).agg(F.count_distinct(other).alias(name))
    return df.select(*e).distinct().join(counts, e, "left")


def on_good_weeks(df: DataFrame, completeness: DataFrame, flags=("complete", "partial")) -> DataFrame:
    """Rows of weeks with an accepted completeness flag; the week list is as short as the calendar."""
    weeks = completeness.where(F.col("data_completeness").isin(*flags)).select("year_week")
    return df.join(F.broadcast(weeks), "year_week", "left_semi")


def compare_history(history: DataFrame, forecast: DataFrame, e: list[str], attrs: DataFrame | None = None) -> DataFrame:
    """Past and forecast totals with growth in percent, and optional attributes."""
    joined = history.join(forecast, e, "inner")
    if attrs is not None:
        joined = joined.join(attrs, e, "inner")
    return joined.withColumn(
        "growth_pct", safe_div(F.col("forecast_total") - F.col("recent_total"), "recent_total") * 100
    )


def sort_by_case(df: DataFrame, col: str, order: list[str], *then: Column | str) -> DataFrame:
    """Rows in an explicit order of labels, unknown labels last."""
    rank = F.lit(len(order))
    for i, label in reversed(list(enumerate(order))):
        rank = F.when(F.col(col) == label, i).otherwise(rank)
    return df.withColumn("sort_key", rank).orderBy("sort_key", *then)


def best_worst(df: DataFrame, metric: str, k: int, order: str = "best", ties: list[str] | None = None) -> DataFrame:
    """The k smallest (best) or largest (worst) values of a metric; ties by key."""
    first = F.asc_nulls_last(metric) if order == "best" else F.desc_nulls_last(metric)
    return df.orderBy(first, *(ties or [])).limit(k)


def problem_entities(df: DataFrame, volume: str = "volume", metric: str = "wmape", min_metric: float = 50.0) -> DataFrame:
    """Entities above the median volume with a poor metric."""
    median = exact_percentiles(df, [], volume, {"_median": 0.5})
    return (
        df.crossJoin(F.broadcast(median))
        .where((F.col(volume) > F.col("_median")) & (F.col(metric) > min_metric))
        .drop("_median")
    )


def union_all(tagged: dict[str, DataFrame], tag: str) -> DataFrame:
    """Aligned rows of several tables, each marked with its name."""
    parts = [df.withColumn(tag, F.lit(name)) for name, df in tagged.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def stack_actual_forecast(actual: DataFrame, forecast: DataFrame) -> DataFrame:
    """History and forecast under one another."""
    return union_all({"actual": actual, "forecast": forecast}, "data_type")


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first of a total order; merged before the shuffle."""
    return first_by(df, key, order)
