"""Closed-form forecasts (F00-F11): (entity, year_week, predicted, actual).

Training statistics are one row per entity, joined onto the test rows. A total order makes every result repeatable:
`ORDER` by week number first, as in one year, or `IN_TIME`.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import week_num, week_start, year_week
from ..functions.clean import exceeds, safe_div
from .joins import compare_history
from .windows import frame, ordered

ORDER = ["week_num", "year_week"]
IN_TIME = ["year_week"]


def normal_quantile(level: float) -> float:
    """How many deviations a two-sided normal interval of this level reaches."""
    return NormalDist().inv_cdf((1 + level) / 2)


def with_week(df: DataFrame) -> DataFrame:
    return df if "week_num" in df.columns else df.withColumn("week_num", week_num("year_week"))


def split(df: DataFrame, cut: int | str = 26) -> tuple[DataFrame, DataFrame]:
    """training and test rows, by `YYYY-Wnn` (text) or by week number (int).

    A number splits every year by itself, so it is a split in time for rows of one year only.
    """
    out = with_week(df)
    first = F.col("week_num") <= cut if isinstance(cut, int) else F.col("year_week") <= cut
    return out.where(first), out.where(~first)


def predict(test: DataFrame, point: DataFrame, e: list[str], y: str, how: str = "inner") -> DataFrame:
    """Join a per-entity `predicted` onto the test rows."""
    return test.select(*e, "year_week", F.col(y).alias("actual")).join(point, e, how)


def sort_key(order: list[str]) -> Column:
    return F.struct(*order)


def last_value(train: DataFrame, e: list[str], y: str, order: list[str] = ORDER) -> DataFrame:
    return with_week(train).groupBy(*e).agg(F.max_by(y, sort_key(order)).alias("predicted"))


def naive_last(
    train: DataFrame, test: DataFrame, e: list[str], y: str, order: list[str] = ORDER, missing: float | None = None
) -> DataFrame:
    """last training value; `missing` scores entities without history."""
    out = predict(test, last_value(train, e, y, order), e, y, "inner" if missing is None else "left")
    return out if missing is None else out.withColumn("predicted", F.coalesce("predicted", F.lit(float(missing))))


def naive_at_week(train: DataFrame, test: DataFrame, e: list[str], y: str, week: int = 26) -> DataFrame:
    """F01, warehouse variant: the mean value at one training week number."""
    point = with_week(train).where(F.col("week_num") == week).groupBy(*e).agg(F.avg(y).alias("predicted"))
    return predict(test, point, e, y)


def moving_average(
    train: DataFrame, test: DataFrame, e: list[str], y: str, n: int = 4, order: list[str] = ORDER
) -> DataFrame:
    """mean of the last n training rows, for entities with n."""
    w = Window.partitionBy(*e).orderBy(*[F.desc(c) for c in order])
    last = with_week(train).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    point = last.groupBy(*e).agg(F.avg(y).alias("predicted"), F.count("*").alias("_n"))
    return predict(test, point.where(F.col("_n") >= n).drop("_n"), e, y)


def moving_average_weeks(
    train: DataFrame, test: DataFrame, e: list[str], y: str, first: int = 23, last: int = 26
) -> DataFrame:
    """F02, warehouse variant: mean of the rows present in a range of week numbers."""
    rows = with_week(train).where(F.col("week_num").between(first, last))
    return predict(test, rows.groupBy(*e).agg(F.avg(y).alias("predicted")), e, y)


def seasonal_naive(train: DataFrame, test: DataFrame, e: list[str], y: str, offset: int = 26) -> DataFrame:
    """training mean at the week number `offset` earlier, else the entity mean."""
    history = with_week(train)
    weekly = history.groupBy(*e, (F.col("week_num") + offset).alias("week_num")).agg(F.avg(y).alias("_w"))
    overall = history.groupBy(*e).agg(F.avg(y).alias("_m"))
    rows = with_week(test).select(*e, "year_week", "week_num", F.col(y).alias("actual"))
    joined = rows.join(overall, e).join(weekly, [*e, "week_num"], "left")
    return joined.select(*e, "year_week", F.coalesce("_w", "_m").alias("predicted"), "actual")


def linear_trend(
    train: DataFrame, test: DataFrame, e: list[str], y: str, min_n: int = 4, across_years: bool = False
) -> DataFrame:
    """least squares on the week number, floored at 0; flat at the mean when all weeks are the same.

    With `across_years` weeks are counted on through the years; within one year both give the same line.
    """
    k = F.floor(F.datediff(week_start("year_week"), F.lit("1970-01-05")) / 7) if across_years else week_num("year_week")
    fit = train.withColumn("_k", k).groupBy(*e).agg(
        F.regr_slope(y, "_k").alias("_s"),
        F.regr_intercept(y, "_k").alias("_i"),
        F.avg(y).alias("_m"),
        F.count("*").alias("_n"),
    )
    line = fit.where(F.col("_n") >= min_n).select(
        *e, F.coalesce("_s", F.lit(0.0)).alias("_s"), F.coalesce("_i", "_m").alias("_i")
    )
    rows = test.select(*e, "year_week", k.alias("_k"), F.col(y).alias("actual"))
    predicted = F.greatest(F.col("_i") + F.col("_s") * F.col("_k"), F.lit(0.0))
    return rows.join(line, e).select(*e, "year_week", predicted.alias("predicted"), "actual")


def smoothed(train: DataFrame, e: list[str], y: str, alpha: float, order: list[str] = ORDER) -> DataFrame:
    """Final smoothed level of each series as a weighted sum: the first value keeps (1-a)^(n-1), value i a(1-a)^(n-i)."""
    back = F.row_number().over(Window.partitionBy(*e).orderBy(*[F.desc(c) for c in order])) - 1
    n = F.count("*").over(Window.partitionBy(*e))
    rows = with_week(train).withColumns({"_back": back, "_n": n})
    start = F.col("_back") == F.col("_n") - 1
    weight = F.pow(F.lit(1 - alpha), F.col("_back")) * F.when(start, 1.0).otherwise(alpha)
    return rows.groupBy(*e).agg(F.sum(weight * F.col(y)).alias("predicted"), F.max("_n").alias("_n"))


def exp_smoothing(
    train: DataFrame, test: DataFrame, e: list[str], y: str, alpha: float = 0.3, order: list[str] = ORDER
) -> DataFrame:
    """simple exponential smoothing of at least two rows, flat forecast."""
    level = smoothed(train, e, y, alpha, order).where(F.col("_n") >= 2).drop("_n")
    return predict(test, level, e, y)


def running_smoothed(df: DataFrame, e: list[str], y: str, alpha: float, name: str = "smoothed") -> DataFrame:
    """The smoothed level after every row, from window sums instead of a fold over all earlier rows.

    Within a block of rows the weights are powers relative to the block's start, so they
    never overflow; the level at the end of the block before enters with its decayed weight.
    """
    keep = 1 - alpha
    if keep <= 0:
        return df.withColumn(name, F.col(y).cast("double"))
    block_rows = max(1, int(100 / -math.log10(keep)))
    w = ordered(e)
    rows = df.withColumn("_i", F.row_number().over(w) - 1).withColumn("_block", F.floor(F.col("_i") / block_rows))
    rows = rows.withColumn("_k", F.col("_i") - F.col("_block") * block_rows)
    weight = F.when(F.col("_i") == 0, 1.0).otherwise(alpha) * F.pow(F.lit(keep), -F.col("_k"))
    inner = Window.partitionBy(*e, "_block").orderBy("year_week").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_local", F.pow(F.lit(keep), F.col("_k")) * F.sum(weight * F.col(y)).over(inner))
    block_end = F.when(F.col("_k") == block_rows - 1, F.col("_local"))
    carried = F.last(block_end, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    level = F.col("_local") + F.coalesce(carried, F.lit(0.0)) * F.pow(F.lit(keep), F.col("_k") + 1)
    return rows.withColumn(name, level).drop("_i", "_block", "_k", "_local")


def walk_forward(
    df: DataFrame, e: list[str], y: str, model: str = "naive", cut: int | str = 26, n: int = 4, alpha: float = 0.3
) -> DataFrame:
    """one-step forecasts of the test weeks from all actuals before them.

    naive is the previous row, ma the mean of the n rows before, smoothing the level after
    the previous row.
    """
    out = with_week(df)
    if model == "naive":
        rows = out.withColumn("predicted", F.lag(y, 1).over(ordered(e)))
    elif model == "ma":
        rows = out.withColumn("predicted", F.avg(y).over(frame(e, "year_week", n)))
    else:
        rows = running_smoothed(out, e, y, alpha, "_level")
        rows = rows.withColumn("predicted", F.lag("_level", 1).over(ordered(e)))
    _, test = split(rows, cut)
    return test.where(F.col("predicted").isNotNull()).select(*e, "year_week", "predicted", F.col(y).alias("actual"))


def median_spike(train: DataFrame, test: DataFrame, e: list[str], y: str, z: float = 2.0) -> DataFrame:
    """the training median as forecast; test weeks z deviations off the training mean are uncertain."""
    stats = train.groupBy(*e).agg(
        F.percentile(y, 0.5).alias("predicted"), F.avg(y).alias("_m"), F.stddev_samp(y).alias("_s")
    )
    joined = predict(test, stats, e, y)
    score = safe_div(F.abs(F.col("actual") - F.col("_m")), "_s")
    level = F.when(exceeds(score, z), "high").otherwise("normal")
    return joined.withColumn("uncertainty", level).drop("_m", "_s")


def route(v1: DataFrame, v2: DataFrame, patterns: DataFrame, e: list[str]) -> DataFrame:
    """cyclical entities take the second model, the others the first; too short series predict nothing."""
    kinds = patterns.select(*e, "pattern", "data_sufficiency")
    cyclical = F.col("pattern") == "cyclical"

    def chosen(preds: DataFrame, keep: Column, version: str) -> DataFrame:
        rows = preds.join(kinds, e).where(keep)
        return rows.select(*e, "year_week", "actual", "predicted", "pattern", "data_sufficiency").withColumn(
            "model_version", F.lit(version)
        )

    both = chosen(v2, cyclical, "V2_cyclical").unionByName(chosen(v1, ~cyclical, "V1_baseline"))
    short = F.col("data_sufficiency") == "insufficient"
    return both.withColumns(
        {
            "predicted": F.when(~short, F.col("predicted")),
            "disclaimer": F.when(short, "Insufficient data for prediction"),
        }
    )


def horizon(
    train: DataFrame, e: list[str], y: str, h: int = 4, level: float = 0.8, n: int = 4
) -> DataFrame:
    """the next h weeks of each series: mean of its last n rows, with a normal interval.

    The deviation is that of one-step residuals against the previous n rows.
    """
    w = Window.partitionBy(*e).orderBy(F.desc("year_week"))
    past = F.avg(y).over(frame(e, "year_week", n))
    rows = train.withColumns({"_res": F.col(y) - past, "_rn": F.row_number().over(w)})
    point = rows.groupBy(*e).agg(
        F.avg(F.when(F.col("_rn") <= n, F.col(y))).alias("forecast"),
        F.coalesce(F.stddev_samp("_res"), F.lit(0.0)).alias("standard_error"),
        F.max("year_week").alias("_last"),
    )
    reach = F.col("standard_error") * normal_quantile(level)
    return point.select(
        *e,
        F.explode(F.sequence(F.lit(1), F.lit(h))).alias("step"),
        "forecast",
        "standard_error",
        F.greatest(F.col("forecast") - reach, F.lit(0.0)).alias("lower_bound"),
        (F.col("forecast") + reach).alias("upper_bound"),
        "_last",
    ).withColumn("year_week", year_week(F.date_add(week_start("_last"), F.col("step") * 7))).drop("_last")


def forecast_totals(forecast: DataFrame, e: list[str], value: str = "forecast") -> DataFrame:
    return forecast.groupBy(*e).agg(F.sum(value).alias("forecast_total"))


def restock(
    forecast: DataFrame, history: DataFrame, products: DataFrame, e: list[str], since: str, y: str, min_recent: float = 100.0, k: int = 20
) -> DataFrame:
    """the k entities with the largest forecast whose recent sales exceed a floor."""
    recent = history.where(F.col("year_week") >= since).groupBy(*e).agg(F.sum(y).alias("recent_total"))
    recent = recent.where(F.col("recent_total") > min_recent)
    joined = compare_history(recent, forecast_totals(forecast, e), e, products)
    return joined.orderBy(F.desc("forecast_total"), *e).limit(k)


def sanity(history: DataFrame, forecast: DataFrame, e: list[str], y: str) -> DataFrame:
    """forecast mean against the mean and range of the history."""
    past = history.groupBy(*e).agg(
        F.avg(y).alias("hist_avg"), F.min(y).alias("hist_min"), F.max(y).alias("hist_max"), F.count("*").alias("weeks")
    )
    ahead = forecast.groupBy(*e).agg(F.avg("forecast").alias("forecast_avg"))
    return past.join(ahead, e).withColumn(
        "pct_diff", safe_div(F.col("forecast_avg") - F.col("hist_avg"), "hist_avg") * 100
    )

