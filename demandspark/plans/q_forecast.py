"""Baseline forecast queries (F00-F11) and the flagship query."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import baselines, evaluate
from . import q_aggregates
from .q_joins import brand, halves, ma_brand, naive_brand
from .registry import CUT, PARTS, query

E, Y = ["brand"], "weekly_quantity"


@query(
    "flagship_category_wmape",
    """
    WITH p AS (SELECT category, year_week, weekly_quantity AS actual,
                 AVG(weekly_quantity) OVER (PARTITION BY category ORDER BY year_week ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS predicted, week_num FROM x_category)
    SELECT category, COUNT(*) AS n_predictions, AVG(abs(actual - predicted)) AS mae, sqrt(AVG(pow(actual - predicted, 2))) AS rmse,
           AVG(abs(actual - predicted) * 100 / NULLIF(actual, 0)) AS mean_mape, SUM(abs(actual - predicted)) * 100 / SUM(actual) AS wmape,
           AVG(predicted - actual) AS bias, median(abs(actual - predicted) * 100 / NULLIF(actual, 0)) AS median_mape
    FROM p WHERE week_num > 26 AND predicted IS NOT NULL GROUP BY category""",
    "mae rmse mean_mape wmape bias median_mape",
)
def _(t):
    weekly = t.category_week().select("category", "year_week", "weekly_quantity")
    preds = baselines.walk_forward(weekly, ["category"], "weekly_quantity", "ma")
    return evaluate.metrics(preds, ["category"])


def marked(train, test):
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test"))).drop("week_num")


@query(
    "F00_split_number",
    "SELECT brand, year_week, weekly_quantity, CASE WHEN week_num <= 26 THEN 'train' ELSE 'test' END AS part FROM x_brand",
    "weekly_quantity",
)
def _(t):
    return marked(*baselines.split(brand(t)))


@query(
    "F00_split_text",
    "SELECT brand, year_week, weekly_quantity, CASE WHEN year_week <= '1998-W26' THEN 'train' ELSE 'test' END AS part FROM x_brand",
    "weekly_quantity",
)
def _(t):
    return marked(*halves(t))


@query("F01_naive_last", "SELECT * FROM x_naive_brand", "actual predicted")
def _(t):
    return naive_brand(t)


@query(
    "F01_naive_last_sku_zero",
    """
    SELECT sku, year_week, weekly_quantity AS actual, COALESCE(p, 0) AS predicted FROM x_sku
    LEFT JOIN (SELECT sku, arg_max(weekly_quantity, year_week) AS p FROM x_sku WHERE year_week <= '1995-W20' GROUP BY sku) USING (sku)
    WHERE year_week > '1995-W20'""",
    "actual predicted",
)
def _(t):
    train, test = baselines.split(t.weekly("sku"), "1995-W20")
    return baselines.naive_last(train, test, ["sku"], Y, ["year_week"], missing=0.0)


@query(
    "F01_naive_at_week",
    """
    SELECT brand, year_week, weekly_quantity AS actual, p AS predicted FROM x_brand
    JOIN (SELECT brand, AVG(weekly_quantity) AS p FROM x_brand WHERE week_num = 26 AND year_week <= '1998-W26' GROUP BY brand) USING (brand) WHERE year_week > '1998-W26'""",
    "actual predicted",
)
def _(t):
    return baselines.naive_at_week(*halves(t), E, Y)


@query("F02_moving_average_4", "SELECT * FROM x_ma_brand", "actual predicted")
def _(t):
    return ma_brand(t)


@query(
    "F02_moving_average_8_sku",
    """
    SELECT sku, year_week, weekly_quantity AS actual, p AS predicted FROM x_sku JOIN (
      SELECT sku, AVG(weekly_quantity) AS p FROM (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY year_week DESC) AS rn
        FROM x_sku WHERE year_week <= '1998-W26') WHERE rn <= 8 GROUP BY sku HAVING COUNT(*) >= 8) USING (sku) WHERE year_week > '1998-W26'""",
    "actual predicted",
)
def _(t):
    return baselines.moving_average(*baselines.split(t.weekly("sku"), CUT), ["sku"], Y, 8, baselines.IN_TIME)


@query(
    "F02_moving_average_weeks",
    """
    SELECT brand, year_week, weekly_quantity AS actual, p AS predicted FROM x_brand
    JOIN (SELECT brand, AVG(weekly_quantity) AS p FROM x_brand WHERE week_num BETWEEN 23 AND 26 AND year_week <= '1998-W26' GROUP BY brand) USING (brand) WHERE year_week > '1998-W26'""",
    "actual predicted",
)
def _(t):
    return baselines.moving_average_weeks(*halves(t), E, Y)


PARTS["x_seasonal_sku"] = """
    SELECT a.sku, a.year_week, a.weekly_quantity AS actual, COALESCE(w.v, m.v) AS predicted FROM x_sku a
    JOIN (SELECT sku, AVG(weekly_quantity) AS v FROM x_sku WHERE year_week <= '1998-W26' GROUP BY sku) m USING (sku)
    LEFT JOIN (SELECT sku, week_num + 26 AS wn, AVG(weekly_quantity) AS v FROM x_sku WHERE year_week <= '1998-W26' GROUP BY 1, 2) w ON a.sku = w.sku AND a.week_num = wn
    WHERE a.year_week > '1998-W26'"""


@query("F03_seasonal_naive", "SELECT * FROM x_seasonal_sku", "actual predicted")
def _(t):
    return baselines.seasonal_naive(*baselines.split(t.weekly("sku"), CUT), ["sku"], Y)


@query(
    "F04_linear_trend",
    """
    WITH x AS (SELECT x_sku.*, (monday - DATE '1970-01-05') // 7 AS k FROM x_sku JOIN x_monday USING (year_week)),
    f AS (SELECT sku, COALESCE(regr_slope(weekly_quantity, k), 0) AS s,
                      COALESCE(regr_intercept(weekly_quantity, k), AVG(weekly_quantity)) AS i FROM x WHERE year_week <= '1998-W26' GROUP BY sku HAVING COUNT(*) >= 4)
    SELECT sku, year_week, weekly_quantity AS actual, GREATEST(i + s * k, 0) AS predicted FROM x JOIN f USING (sku) WHERE year_week > '1998-W26'""",
    "actual predicted",
)
def _(t):
    return baselines.linear_trend(*baselines.split(t.weekly("sku"), CUT), ["sku"], Y, across_years=True)


def smoothing_sql(alpha: float, source: str, key: str) -> str:
    """Smoothing as a recurrence, written independently of the weighted sum under test."""
    return f"""
    WITH RECURSIVE o AS (SELECT {key}, weekly_quantity AS y, row_number() OVER (PARTITION BY {key} ORDER BY year_week) AS i,
                      COUNT(*) OVER (PARTITION BY {key}) AS n FROM {source} WHERE year_week <= '1998-W26'),
    r AS (SELECT {key}, i, n, y AS s FROM o WHERE i = 1 UNION ALL
          SELECT o.{key}, o.i, o.n, {alpha} * o.y + (1 - {alpha}) * r.s FROM r JOIN o ON r.{key} = o.{key} AND o.i = r.i + 1)
    SELECT {key}, year_week, weekly_quantity AS actual, s AS predicted FROM {source} JOIN (SELECT {key}, s FROM r WHERE i = n AND n >= 2) USING ({key}) WHERE year_week > '1998-W26'"""


for alpha in (0.3, 0.5):
    tag = str(alpha).replace(".", "_")

    @query(f"F05_exp_smoothing_{tag}", smoothing_sql(alpha, "x_brand", "brand"), "actual predicted")
    def _(t, alpha=alpha):
        return baselines.exp_smoothing(*halves(t), E, Y, alpha, baselines.IN_TIME)


@query("F05_exp_smoothing_sku", smoothing_sql(0.3, "x_sku", "sku"), "actual predicted")
def _(t):
    return baselines.exp_smoothing(*baselines.split(t.weekly("sku"), CUT), ["sku"], Y, 0.3, baselines.IN_TIME)


@query(
    "F06_walk_forward_naive",
    """
    SELECT brand, year_week, actual, predicted FROM (SELECT brand, year_week, week_num, weekly_quantity AS actual,
      LAG(weekly_quantity) OVER (PARTITION BY brand ORDER BY year_week) AS predicted FROM x_brand) WHERE week_num > 26 AND predicted IS NOT NULL""",
    "actual predicted",
)
def _(t):
    return baselines.walk_forward(brand(t), E, Y, "naive")


@query("F06_walk_forward_ma", "SELECT * FROM x_ma_sku", "actual predicted")
def _(t):
    return q_aggregates.ma_sku(t)


@query(
    "F06_walk_forward_smoothing",
    """
    WITH RECURSIVE o AS (SELECT sku, year_week, week_num, weekly_quantity AS y, row_number() OVER (PARTITION BY sku ORDER BY year_week) AS i FROM x_sku),
    r AS (SELECT sku, i, y AS s FROM o WHERE i = 1 UNION ALL SELECT o.sku, o.i, 0.3 * o.y + 0.7 * r.s FROM r JOIN o ON r.sku = o.sku AND o.i = r.i + 1)
    SELECT o.sku, year_week, y AS actual, s AS predicted FROM o JOIN r ON o.sku = r.sku AND o.i = r.i + 1 WHERE week_num > 26""",
    "actual predicted",
)
def _(t):
    return baselines.walk_forward(t.weekly("sku"), ["sku"], Y, "smoothing")


@query(
    "F07_median_spike",
    """
    SELECT sku, year_week, weekly_quantity AS actual, med AS predicted,
           CASE WHEN abs(weekly_quantity - m) / NULLIF(s, 0) > 2 THEN 'high' ELSE 'normal' END AS uncertainty
    FROM x_sku JOIN (SELECT sku, median(weekly_quantity) AS med, AVG(weekly_quantity) AS m, stddev_samp(weekly_quantity) AS s FROM x_sku WHERE year_week <= '1998-W26' GROUP BY sku) USING (sku)
    WHERE year_week > '1998-W26'""",
    "actual predicted",
)
def _(t):
    return baselines.median_spike(*baselines.split(t.weekly("sku"), CUT), ["sku"], Y)


PARTS["x_routed"] = """
    SELECT sku, year_week, actual, CASE WHEN data_sufficiency <> 'insufficient' THEN predicted END AS predicted, pattern, data_sufficiency, 'V2_cyclical' AS model_version
    FROM x_seasonal_sku JOIN (SELECT sku, pattern, data_sufficiency FROM x_pattern) USING (sku) WHERE pattern = 'cyclical'
    UNION ALL
    SELECT sku, year_week, actual, CASE WHEN data_sufficiency <> 'insufficient' THEN predicted END, pattern, data_sufficiency, 'V1_baseline'
    FROM x_ma_sku JOIN (SELECT sku, pattern, data_sufficiency FROM x_pattern) USING (sku) WHERE pattern <> 'cyclical'"""


def routed(t):
    seasonal = baselines.seasonal_naive(*baselines.split(t.weekly("sku"), CUT), ["sku"], Y)
    return baselines.route(q_aggregates.ma_sku(t), seasonal, q_aggregates.patterns(t), ["sku"])


@query(
    "F08_route",
    "SELECT *, CASE WHEN data_sufficiency = 'insufficient' THEN 'Insufficient data for prediction' END AS disclaimer FROM x_routed",
    "actual predicted",
)
def _(t):
    return routed(t)


PARTS["x_horizon"] = """
    WITH r AS (SELECT brand, year_week, weekly_quantity AS q, row_number() OVER (PARTITION BY brand ORDER BY year_week DESC) AS rn,
                 weekly_quantity - AVG(weekly_quantity) OVER (PARTITION BY brand ORDER BY year_week ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS res FROM x_brand),
    p AS (SELECT brand, AVG(q) FILTER (rn <= 4) AS forecast, COALESCE(stddev_samp(res), 0) AS standard_error, MAX(year_week) AS last FROM r GROUP BY brand)
    SELECT brand, CAST(step AS INTEGER) AS step, forecast, standard_error, GREATEST(forecast - 1.2815515655446004 * standard_error, 0) AS lower_bound,
           forecast + 1.2815515655446004 * standard_error AS upper_bound, strftime(monday + CAST(step * 7 AS INTEGER), '%G-W%V') AS year_week
    FROM p JOIN x_monday m ON m.year_week = last, (SELECT unnest(range(1, 5)) AS step)"""


def horizon(t):
    return baselines.horizon(brand(t), E, Y)


@query("F11_horizon", "SELECT * FROM x_horizon", "forecast standard_error lower_bound upper_bound")
def _(t):
    return horizon(t)


@query(
    "F09_restock",
    """
    SELECT brand, recent_total, forecast_total, (forecast_total - recent_total) / recent_total * 100 AS growth_pct, parts
    FROM (SELECT brand, SUM(weekly_quantity) AS recent_total FROM x_brand WHERE year_week >= '2001-W20' GROUP BY brand HAVING SUM(weekly_quantity) > 100)
    JOIN (SELECT brand, SUM(forecast) AS forecast_total FROM x_horizon GROUP BY brand) USING (brand)
    JOIN (SELECT p_brand AS brand, COUNT(*) AS parts FROM part GROUP BY 1) USING (brand) ORDER BY round(forecast_total, 6) DESC, brand LIMIT 20""",
    "recent_total forecast_total growth_pct",
)
def _(t):
    parts = t.products().groupBy("brand").agg(F.count("*").alias("parts"))
    return baselines.restock(horizon(t), brand(t), parts, E, "2001-W20", Y)


@query(
    "F10_sanity",
    """
    SELECT brand, AVG(weekly_quantity) AS hist_avg, MIN(weekly_quantity) AS hist_min, MAX(weekly_quantity) AS hist_max, COUNT(*) AS weeks, MIN(f) AS forecast_avg,
           (MIN(f) - AVG(weekly_quantity)) / AVG(weekly_quantity) * 100 AS pct_diff
    FROM x_brand JOIN (SELECT brand, AVG(forecast) AS f FROM x_horizon GROUP BY brand) USING (brand) GROUP BY brand""",
    "hist_avg hist_min hist_max forecast_avg pct_diff",
)
def _(t):
    return baselines.sanity(brand(t), horizon(t), E, Y)
