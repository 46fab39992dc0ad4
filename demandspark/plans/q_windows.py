"""Window queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import windows
from . import q_aggregates
from .registry import CUT, query

OVER = "OVER (PARTITION BY sku ORDER BY year_week)"


def over(n: int, current: bool = False, key: str = "sku") -> str:
    last = "CURRENT ROW" if current else "1 PRECEDING"
    first = n - 1 if current else n
    return f"OVER (PARTITION BY {key} ORDER BY year_week ROWS BETWEEN {first} PRECEDING AND {last})"


def sku(t):
    return t.sku_week().select("sku", "year_week", "weekly_quantity")


SERIES = (["sku"], "year_week", "weekly_quantity")


@query(
    "W01_lags",
    "SELECT sku, year_week, weekly_quantity, "
    + ", ".join(f"LAG(weekly_quantity, {k}) {OVER} AS lag{k}" for k in (1, 2, 3, 4, 8, 12))
    + " FROM x_sku",
    "weekly_quantity lag1 lag2 lag3 lag4 lag8 lag12",
)
def _(t):
    return windows.lags(sku(t), *SERIES, (1, 2, 3, 4, 8, 12))


@query(
    "W02_rolling_avg_excl",
    "SELECT sku, year_week, weekly_quantity, "
    + ", ".join(f"AVG(weekly_quantity) {over(k)} AS rolling_avg_{k}w" for k in (4, 8, 12))
    + " FROM x_sku",
    "weekly_quantity rolling_avg_4w rolling_avg_8w rolling_avg_12w",
)
def _(t):
    df = sku(t)
    for n in (4, 8, 12):
        df = windows.rolling_mean(df, *SERIES, n)
    return df


@query(
    "W03_rolling_avg_incl",
    f"""
    SELECT sku, year_week, AVG(weekly_quantity) {over(4, True)} AS rolling_avg_4w, AVG(avg_unit_price) {over(4, True)} AS price_rolling_avg_4w FROM x_sku""",
    "rolling_avg_4w price_rolling_avg_4w",
)
def _(t):
    df = windows.rolling_mean(t.sku_week(), *SERIES, 4, True)
    df = windows.rolling_mean(df, ["sku"], "year_week", "avg_unit_price", 4, True, "price_rolling_avg_4w")
    return df.select("sku", "year_week", "rolling_avg_4w", "price_rolling_avg_4w")


@query(
    "W04_rolling_std",
    f"""
    SELECT sku, year_week, weekly_quantity, stddev_samp(weekly_quantity) {over(4)} AS std_excl, stddev_samp(weekly_quantity) {over(4, True)} AS std_incl FROM x_sku""",
    "weekly_quantity std_excl std_incl",
)
def _(t):
    df = windows.rolling_std(sku(t), *SERIES, 4, False, "std_excl")
    return windows.rolling_std(df, *SERIES, 4, True, "std_incl")


@query(
    "W05_rolling_minmax",
    f"SELECT sku, year_week, weekly_quantity, MIN(weekly_quantity) {over(4)} AS rolling_min_4w, MAX(weekly_quantity) {over(4)} AS rolling_max_4w FROM x_sku",
    "weekly_quantity rolling_min_4w rolling_max_4w",
)
def _(t):
    return windows.rolling_minmax(sku(t), *SERIES)


@query(
    "W06_changes",
    f"""
    SELECT sku, year_week, weekly_quantity, weekly_quantity - LAG(weekly_quantity) {OVER} AS diff_1w,
           (weekly_quantity - LAG(weekly_quantity, 4) {OVER}) / NULLIF(LAG(weekly_quantity, 4) {OVER}, 0) AS pct_change_4w FROM x_sku""",
    "weekly_quantity diff_1w pct_change_4w",
)
def _(t):
    return windows.changes(sku(t), *SERIES)


@query(
    "W07_trend",
    """
    SELECT sku, year_week, weekly_quantity, CASE WHEN l4 IS NOT NULL THEN LEAST(GREATEST((l1 - l4) / NULLIF(l4, 0), -10), 10) END AS trend_4w, l1 - l2 AS momentum
    FROM (SELECT *, LAG(weekly_quantity, 1) OVER w AS l1, LAG(weekly_quantity, 2) OVER w AS l2, LAG(weekly_quantity, 4) OVER w AS l4
          FROM x_sku WINDOW w AS (PARTITION BY sku ORDER BY year_week))""",
    "weekly_quantity trend_4w momentum",
)
def _(t):
    return windows.trend(sku(t), *SERIES)


@query(
    "W08_volatility",
    f"""
    SELECT sku, year_week, weekly_quantity, CASE WHEN s IS NOT NULL THEN LEAST(GREATEST(s / NULLIF(m, 0), 0), 10) END AS cv_4w, (hi - lo) / NULLIF(m, 0) AS range_ratio
    FROM (SELECT *, AVG(weekly_quantity) {over(4)} AS m, stddev_samp(weekly_quantity) {over(4)} AS s, MIN(weekly_quantity) {over(4)} AS lo,
                 MAX(weekly_quantity) {over(4)} AS hi FROM x_sku)""",
    "weekly_quantity cv_4w range_ratio",
)
def _(t):
    return windows.volatility(sku(t), *SERIES)


@query(
    "W09_price_features",
    f"""
    SELECT sku, year_week, avg_unit_price, p AS prev_price, avg_unit_price - p AS price_change, round((avg_unit_price - p) / p * 100, 2) AS price_change_pct,
           m - avg_unit_price AS price_trend_4w, avg_unit_price - a AS price_vs_avg
    FROM (SELECT *, LAG(avg_unit_price) {OVER} AS p, AVG(avg_unit_price) {over(4, True)} AS m, AVG(avg_unit_price) OVER (PARTITION BY sku) AS a FROM x_sku)""",
    "avg_unit_price prev_price price_change price_change_pct price_trend_4w price_vs_avg",
)
def _(t):
    return windows.price_features(t.sku_week().select("sku", "year_week", "avg_unit_price"), ["sku"], "year_week")


@query(
    "W10_share",
    """
    SELECT week_start, region_name, weekly_revenue, weekly_revenue / SUM(weekly_revenue) OVER (PARTITION BY week_start) AS revenue_share,
           transaction_count / SUM(transaction_count) OVER (PARTITION BY week_start) AS transaction_share FROM x_region_week""",
    "weekly_revenue revenue_share transaction_share",
)
def _(t):
    df = q_aggregates.region_week(t).select("week_start", "region_name", "weekly_revenue", "transaction_count")
    df = windows.share(df, ["week_start"], "weekly_revenue", "revenue_share")
    return windows.share(df, ["week_start"], "transaction_count", "transaction_share").drop("transaction_count")


@query(
    "W11_rank_in",
    """
    SELECT week_start, region_name, CAST(rank() OVER (PARTITION BY week_start ORDER BY weekly_revenue DESC) AS INTEGER) AS revenue_rank,
           rank() OVER (PARTITION BY week_start ORDER BY transaction_count DESC) + (COUNT(*) OVER (PARTITION BY week_start, transaction_count) - 1) / 2 AS average_rank
    FROM x_region_week""",
    "average_rank",
)
def _(t):
    df = q_aggregates.region_week(t).select("week_start", "region_name", "weekly_revenue", "transaction_count")
    df = windows.rank_in(df, ["week_start"], "weekly_revenue", "rank", "revenue_rank")
    return windows.rank_in(df, ["week_start"], "transaction_count", "average", "average_rank").drop("weekly_revenue", "transaction_count")


@query(
    "W12_growth",
    """
    WITH g AS (SELECT week_start, region_name, weekly_revenue / NULLIF(LAG(weekly_revenue) OVER (PARTITION BY region_name ORDER BY week_start), 0) - 1 AS wow_growth
               FROM x_region_week)
    SELECT *, AVG(wow_growth) OVER (PARTITION BY week_start) AS avg_growth FROM g""",
    "wow_growth avg_growth",
)
def _(t):
    df = q_aggregates.region_week(t).select("week_start", "region_name", "weekly_revenue")
    return windows.growth(df, ["region_name"], "week_start", "weekly_revenue").drop("weekly_revenue")


@query(
    "W13_tail",
    """
    SELECT sku, year_week, weekly_quantity FROM (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY year_week DESC) AS rn FROM x_sku) WHERE rn <= 4""",
    "weekly_quantity",
)
def _(t):
    return windows.tail(sku(t), ["sku"], ["year_week"], 4)


@query(
    "W14_recent_total",
    "SELECT sku, SUM(weekly_quantity) AS last_4w_actual FROM x_sku WHERE year_week >= '2001-W28' GROUP BY sku",
    "last_4w_actual",
)
def _(t):
    return windows.recent_total(sku(t), ["sku"], "weekly_quantity", "2001-W28", "last_4w_actual")


@query("W15_train_weeks", "SELECT sku, COUNT(*) AS h1_weeks FROM x_sku WHERE year_week <= '1998-W26' GROUP BY sku")
def _(t):
    from ..operators.baselines import split

    return windows.train_weeks(split(t.sku_week(), CUT)[0], ["sku"])


@query(
    "W16_fill_gaps",
    """
    WITH s AS (SELECT sku, monday, weekly_quantity AS q, LEAD(monday) OVER w AS nm, LEAD(weekly_quantity) OVER w AS nq
               FROM x_sku JOIN x_monday USING (year_week) WINDOW w AS (PARTITION BY sku ORDER BY monday)),
    g AS (SELECT *, COALESCE((nm - monday) // 7 - 1, 0) AS gap FROM s),
    r AS (SELECT *, unnest(range(gap + 1)) AS i FROM g)
    SELECT sku, CAST(monday + CAST(i * 7 AS INTEGER) AS DATE) AS week_start,
           CASE WHEN i = 0 THEN q WHEN gap <= 2 THEN q + (nq - q) * i / (gap + 1) WHEN gap > 4 THEN 0.0 END AS weekly_quantity,
           CASE WHEN i = 0 THEN 'observed' WHEN gap <= 2 THEN 'interpolated' WHEN gap > 4 THEN 'inactive' ELSE 'gap' END AS week_status
    FROM r""",
    "weekly_quantity",
)
def _(t):
    return windows.fill_gaps(sku(t), ["sku"], "weekly_quantity")


@query(
    "W17_rank_in_category",
    """
    SELECT sku, year_week, category, weekly_quantity, rank() OVER (PARTITION BY category, year_week ORDER BY weekly_quantity DESC) AS rank_in_category
    FROM x_sku JOIN (SELECT p_partkey AS sku, p_type AS category FROM part) USING (sku)""",
    "weekly_quantity",
)
def _(t):
    df = sku(t).join(t.products().select("sku", "category"), "sku")
    return windows.rank_in_group(df, ["category", "year_week"], "weekly_quantity")


@query(
    "W17_category_growth",
    """
    SELECT category, year_week, weekly_quantity / NULLIF(LAG(weekly_quantity) OVER (PARTITION BY category ORDER BY year_week), 0) - 1 AS growth FROM x_category""",
    "growth",
)
def _(t):
    df = windows.growth(t.category_week().select("category", "year_week", "weekly_quantity"), ["category"], "year_week", "weekly_quantity")
    return df.select("category", "year_week", F.col("wow_growth").alias("growth"))


@query(
    "W18_spikes",
    """
    SELECT sku, year_week, weekly_quantity, CAST(COALESCE(abs(weekly_quantity - m) / NULLIF(s, 0) > 2, false) AS INTEGER) AS is_spike, med AS baseline
    FROM x_sku JOIN (SELECT sku, AVG(weekly_quantity) AS m, stddev_samp(weekly_quantity) AS s, median(weekly_quantity) AS med FROM x_sku GROUP BY sku) USING (sku)""",
    "weekly_quantity baseline",
)
def _(t):
    return windows.spikes(sku(t), ["sku"], "weekly_quantity")
