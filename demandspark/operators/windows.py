"""Row-offset features of weekly series.

The tables are already one row per (entity, week), so a window group is at most as
long as the calendar. Offsets count existing rows, not calendar weeks; `fill_gaps`
makes them the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import week_start
from ..functions.clean import clip, safe_div
from ..functions.distributed import key_join, rank_large
from .quality import outliers_z


def ordered(e: list[str], t: str | list[str] = "year_week"):
    keys = [t] if isinstance(t, str) else t
    return Window.partitionBy(*e).orderBy(*keys)


def frame(e: list[str], t, n: int, include_current: bool = False):
    """The last n rows, ending before (default) or at the current row."""
    w = ordered(e, t)
    return w.rowsBetween(-(n - 1), 0) if include_current else w.rowsBetween(-n, -1)


def lags(df: DataFrame, e: list[str], t: str, y: str, ks=(1, 2, 4), prefix: str = "lag", suffix: str = "") -> DataFrame:
    """W01."""
    w = ordered(e, t)
    return df.withColumns({f"{prefix}{k}{suffix}": F.lag(y, k).over(w) for k in ks})


def rolling_mean(
    df: DataFrame, e: list[str], t: str, y: str, n: int = 4, include_current: bool = False, name: str | None = None
) -> DataFrame:
    """W02/W03."""
    return df.withColumn(name or f"rolling_avg_{n}w", F.avg(y).over(frame(e, t, n, include_current)))


def rolling_std(
    df: DataFrame, e: list[str], t: str, y: str, n: int = 4, include_current: bool = False, name: str | None = None
) -> DataFrame:
    """Sample deviation, NULL under two rows."""
    return df.withColumn(name or f"rolling_std_{n}w", F.stddev_samp(y).over(frame(e, t, n, include_current)))


def rolling_minmax(df: DataFrame, e: list[str], t: str, y: str, n: int = 4) -> DataFrame:
    """W05."""
    w = frame(e, t, n)
    return df.withColumns({f"rolling_min_{n}w": F.min(y).over(w), f"rolling_max_{n}w": F.max(y).over(w)})


def changes(df: DataFrame, e: list[str], t: str, y: str) -> DataFrame:
    """Difference to the previous row, relative change over four rows."""
    w = ordered(e, t)
    four = F.lag(y, 4).over(w)
    return df.withColumns(
        {"diff_1w": F.col(y) - F.lag(y, 1).over(w), "pct_change_4w": safe_div(F.col(y) - four, four)}
    )


def trend(df: DataFrame, e: list[str], t: str, y: str, bound: float = 10.0) -> DataFrame:
    """Relative trend lag4 to lag1 (clipped) and momentum."""
    w = ordered(e, t)
    one, two, four = (F.lag(y, k).over(w) for k in (1, 2, 4))
    return df.withColumns({"trend_4w": clip(safe_div(one - four, four), -bound, bound), "momentum": one - two})


def volatility(df: DataFrame, e: list[str], t: str, y: str, n: int = 4, bound: float = 10.0) -> DataFrame:
    """Deviation over mean (clipped to 0..bound) and range over mean of the last n rows."""
    w = frame(e, t, n)
    mean = F.avg(y).over(w)
    return df.withColumns(
        {
            f"cv_{n}w": clip(safe_div(F.stddev_samp(y).over(w), mean), 0.0, bound),
            "range_ratio": safe_div(F.max(y).over(w) - F.min(y).over(w), mean),
        }
    )


def price_features(df: DataFrame, e: list[str], t: str, price: str = "avg_unit_price") -> DataFrame:
    """Previous price, change, change in percent (2 dp), and four-row mean minus price."""
    w = ordered(e, t)
    previous = F.lag(price, 1).over(w)
    change = F.col(price) - previous
    return df.withColumns(
        {
            "prev_price": previous,
            "price_change": change,
            "price_change_pct": F.round(safe_div(change, previous) * 100, 2),
            "price_trend_4w": F.avg(price).over(frame(e, t, 4, True)) - F.col(price),
            "price_vs_avg": F.col(price) - F.avg(price).over(Window.partitionBy(*e)),
        }
    )


def share(df: DataFrame, by: list[str], y: str, name: str) -> DataFrame:
    """Part of the period total.

    A period may hold every entity, so the totals are aggregated (one row per period) and
    joined, not windowed.
    """
    total = df.groupBy(*by).agg(F.sum(y).alias("_t"))
    return key_join(df, total, by).withColumn(name, safe_div(y, "_t")).drop("_t")


def rank_in(df: DataFrame, by: list[str], y: str, method: str = "rank", name: str = "rank") -> DataFrame:
    """Descending rank among a few rows per period (regions); `average` shares ties like pandas."""
    w = Window.partitionBy(*by).orderBy(F.desc(y))
    rank: Column = F.rank().over(w)
    if method == "average":
        rank = rank + (F.count("*").over(Window.partitionBy(*by, y)) - 1) / 2
    return df.withColumn(name, rank)


def growth(df: DataFrame, e: list[str], t: str, y: str) -> DataFrame:
    """Growth on the previous row, and its mean over the entities of the period."""
    grown = df.withColumn("wow_growth", safe_div(y, F.lag(y, 1).over(ordered(e, t))) - 1)
    means = grown.groupBy(t).agg(F.avg("wow_growth").alias("avg_growth"))
    return key_join(grown, means, [t])


def tail(df: DataFrame, e: list[str], t: list[str], n: int) -> DataFrame:
    """The last n rows of each entity."""
    w = Window.partitionBy(*e).orderBy(*[F.desc(c) for c in t])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def recent_total(df: DataFrame, e: list[str], y: str, since: str, name: str = "recent_total") -> DataFrame:
    """Total from a week on."""
    return df.where(F.col("year_week") >= since).groupBy(*e).agg(F.sum(y).alias(name))


def train_weeks(df: DataFrame, e: list[str], name: str = "h1_weeks") -> DataFrame:
    """Training rows per entity."""
    return df.groupBy(*e).agg(F.count("*").alias(name))


def fill_gaps(
    df: DataFrame, e: list[str], y: str, max_linear: int = 2, inactive: int = 4
) -> DataFrame:
    """Every week between an entity's first and last, with a status per week.

    Gaps of up to `max_linear` weeks are interpolated, gaps over `inactive` weeks are zero
    and inactive, those between stay NULL. Each row spawns the missing weeks up to its
    successor, so no calendar is joined and the only shuffle is the entity window.
    """
    w = Window.partitionBy(*e).orderBy("_w")
    steps = (
        df.select(*e, week_start("year_week").alias("_w"), F.col(y).cast("double").alias("_y"))
        .withColumns({"_next_w": F.lead("_w").over(w), "_next_y": F.lead("_y").over(w)})
        .withColumn("_gap", F.coalesce(F.floor(F.datediff("_next_w", "_w") / 7) - 1, F.lit(0)))
    )
    grid = steps.select(*e, "_w", "_y", "_next_y", "_gap", F.explode(F.sequence(F.lit(0), F.col("_gap").cast("int"))).alias("_i"))
    observed = F.col("_i") == 0
    linear = F.col("_y") + (F.col("_next_y") - F.col("_y")) * F.col("_i") / (F.col("_gap") + 1)
    return grid.select(
        *e,
        F.date_add("_w", F.col("_i") * 7).alias("week_start"),
        F.when(observed, F.col("_y"))
        .when(F.col("_gap") <= max_linear, linear)
        .when(F.col("_gap") > inactive, 0.0)
        .alias(y),
        F.when(observed, "observed")
        .when(F.col("_gap") <= max_linear, "interpolated")
        .when(F.col("_gap") > inactive, "inactive")
        .otherwise("gap")
        .alias("week_status"),
    )


def rank_in_group(df: DataFrame, by: list[str], y: str, name: str = "rank_in_category") -> DataFrame:
    """Descending rank among any number of rows per group."""
    return rank_large(df, by, y, name)


def spikes(df: DataFrame, e: list[str], y: str, z: float = 2.0) -> DataFrame:
    """Rows more than z deviations off the entity mean, with the entity median as baseline."""
    flagged = outliers_z(df, e, y, z, 1, "is_spike")
    return flagged.withColumn("baseline", F.percentile(y, 0.5).over(Window.partitionBy(*e)))
