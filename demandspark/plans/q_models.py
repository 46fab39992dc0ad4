"""Trained-model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, baselines, boosting, customers, models, moments
from ..operators.quality import winsorise
from ..session import pin
from . import q_aggregates
from .q_joins import ma_brand, naive_brand
from .registry import CUT, PARTS, Sales, query

Y = "weekly_quantity"
CORE = ["lag1", "lag2", "lag4", "rolling_avg_4w"]
# fixed values: the settings compared by cross-validation
SETTINGS = [
    {"iters": 100, "depth": 4, "step": 0.1},
    {"iters": 200, "depth": 6, "step": 0.1},
    {"iters": 300, "depth": 8, "step": 0.05},
]
FEATURES = models.GLOBAL_FEATURES
SERIES_FEATURES = [*FEATURES, "rolling_std_4w", "rolling_min_4w", "rolling_max_4w", "cv_4w", "price_change_pct"]


def feature_halves(weekly, e):
    """Training and test rows; the features are written once, as fits read them several times.

    No model takes the orders or the revenue; counting distinct orders would shuffle every line twice.
    """
    return baselines.split(pin(models.model_features(weekly.drop("order_count", "weekly_revenue"), e)), CUT)


def open_halves(weekly, e):
    """The same, not written: the per-entity fits write their own frame."""
    return baselines.split(models.model_features(weekly, e), CUT)


def sku_halves(t: Sales):
    return feature_halves(t.sku_week(), ["sku"])


def brand_halves(t: Sales):
    return feature_halves(t.brand_week(), ["brand"])


# the training rows of M01 and M02 with all core features, and the sums of every split that the bins allow
PARTS["x_train"] = """
    SELECT * FROM (
      SELECT s.sku, s.year_week, p_type AS category, weekly_quantity AS y, LAG(weekly_quantity, 1) OVER w AS lag1, LAG(weekly_quantity, 2) OVER w AS lag2, LAG(weekly_quantity, 4) OVER w AS lag4,
             AVG(weekly_quantity) OVER (PARTITION BY s.sku ORDER BY s.year_week ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS rolling_avg_4w, avg_unit_price,
             CAST(week_num AS DOUBLE) AS week_num, CAST(week_num = 47 AS INTEGER)::DOUBLE AS is_w47
      FROM x_sku s JOIN part ON p_partkey = s.sku WINDOW w AS (PARTITION BY s.sku ORDER BY s.year_week))
    WHERE lag4 IS NOT NULL AND year_week <= '1998-W26'"""
PARTS["x_cells"] = """
    SELECT sku, year_week, category, y, unnest(['lag1', 'lag2', 'lag4', 'rolling_avg_4w', 'avg_unit_price', 'week_num', 'is_w47']) AS feature,
           unnest(range(7)) AS place, unnest([lag1, lag2, lag4, rolling_avg_4w, avg_unit_price, week_num, is_w47]) AS x FROM x_train"""
PARTS["x_edges"] = """
    SELECT DISTINCT feature, place, unnest(quantile_disc(x, list_transform(range(1, 64), lambda k: k / 64.0))) AS threshold FROM x_cells GROUP BY feature, place"""


def split_sql(group: str, name: str) -> str:
    """The best first split of each group, by its sums on either side of every edge; equal gains: the first feature and edge."""
    return f"""
    m AS (SELECT {group} AS g, AVG(y) AS mean, COUNT(*) AS n FROM x_train GROUP BY 1),
    h AS (SELECT {group} AS g, feature, place, x, COUNT(*) AS n, SUM(y) AS s FROM x_cells GROUP BY ALL),
    l AS (SELECT h.g, h.feature, h.place, threshold, SUM(h.n) AS n_left, SUM(h.s - h.n * mean) AS s_left, ANY_VALUE(m.n) AS n
          FROM h JOIN x_edges e ON h.feature = e.feature AND h.x <= threshold JOIN m ON h.g = m.g GROUP BY ALL),
    c AS (SELECT *, s_left * s_left / n_left + s_left * s_left / (n - n_left) AS gain FROM l WHERE n_left < n)
    SELECT {name}feature, threshold, gain, CAST(n AS BIGINT) AS n_rows FROM c QUALIFY row_number() OVER (PARTITION BY g ORDER BY round(gain, 4) DESC, place, threshold) = 1"""


@query("M01_gbt_global")
def _(t):
    return models.gbt_global(*sku_halves(t), ["sku"], FEATURES, Y, core=CORE)


@query(
    "M01_training_rows",
    "SELECT COUNT(*) AS n_rows, COUNT(DISTINCT sku) AS n_entities, SUM(y) AS total FROM x_train",
    "total",
)
def _(t):
    train = models.complete_rows(open_halves(t.sku_week(), ["sku"])[0], CORE)
    return train.agg(F.count("*").alias("n_rows"), F.count_distinct("sku").alias("n_entities"), F.sum(Y).alias("total"))


@query("M01_root_split", "WITH " + split_sql("0", "").lstrip(), "threshold gain")
def _(t):
    nodes = models.fit(sku_halves(t)[0], FEATURES, Y, CORE, iters=1)
    return boosting.first_splits(nodes).drop("model")


def group_halves(t: Sales):
    weekly = t.sku_week().join(t.products().select("sku", "category"), "sku")
    return feature_halves(weekly, ["sku"])


@query("M02_gbt_by_group")
def _(t):
    return models.gbt_by_group(*group_halves(t), ["sku"], "category", FEATURES, Y, core=CORE)


@query("M02_training_rows", "SELECT category, COUNT(*) AS n_rows, COUNT(*) >= 50 AS own_model FROM x_train GROUP BY category")
def _(t):
    return models.group_training_rows(group_halves(t)[0], "category", CORE)


@query("M02_first_splits", "WITH " + split_sql("category", "g AS category, ").lstrip(), "threshold gain")
def _(t):
    train = models.complete_rows(group_halves(t)[0], CORE)
    codes = pin(models.grouped(train, "category"))
    nodes = models.group_models(train, "category", codes, FEATURES, Y, iters=1)
    return boosting.first_splits(nodes).join(codes, "model").select("category", "feature", "threshold", "gain", "n_rows")


@query(
    "M03_training_rows",
    """
    WITH f AS (SELECT sku, year_week, LAG(weekly_quantity, 4) OVER (PARTITION BY sku ORDER BY year_week) AS lag4 FROM x_sku)
    SELECT sku, COUNT(*) AS n_rows, COUNT(lag4) AS n_complete, COUNT(lag4) >= 4 AS eligible FROM f WHERE year_week <= '1998-W26' GROUP BY sku""",
)
def _(t):
    return models.training_rows(open_halves(t.sku_week(), ["sku"])[0], ["sku"], CORE)


@query("M03_gbt_by_sku")
def _(t):
    halves = open_halves(t.sku_week(), ["sku"])
    return models.gbt_by_entity(*halves, ["sku"], SERIES_FEATURES, Y, min_rows=4, core=CORE)


@query(
    "M03_scored_rows",
    """
    WITH f AS (SELECT sku, year_week, weekly_quantity, LAG(weekly_quantity, 4) OVER (PARTITION BY sku ORDER BY year_week) AS lag4 FROM x_sku),
    own AS (SELECT sku FROM f WHERE lag4 IS NOT NULL AND year_week <= '1998-W26' GROUP BY sku HAVING COUNT(*) >= 4)
    SELECT CASE WHEN sku IN (SELECT sku FROM own) THEN 'sku' ELSE 'global' END AS model_type, COUNT(*) AS n_rows, COUNT(DISTINCT sku) AS n_entities, SUM(weekly_quantity) AS total
    FROM f WHERE lag4 IS NOT NULL AND year_week > '1998-W26' GROUP BY 1""",
    "total",
)
def _(t):
    # which rows are scored, and by which kind of model, does not depend on the number of trees
    preds = models.gbt_by_entity(*open_halves(t.sku_week(), ["sku"]), ["sku"], SERIES_FEATURES, Y, trees=1, global_iters=1, core=CORE)
    return preds.groupBy("model_type").agg(F.count("predicted").alias("n_rows"), F.count_distinct("sku").alias("n_entities"), F.sum("actual").alias("total"))


@query("M03_gbt_by_brand")
def _(t):
    halves = open_halves(t.brand_week(), ["brand"])
    return models.gbt_by_entity(*halves, ["brand"], SERIES_FEATURES, Y, model_type="category", core=CORE)


@query("M03_gbt_by_customer")
def _(t):
    halves = open_halves(t.customer_week(), ["customer_id"])
    return models.gbt_by_entity(
        *halves, ["customer_id"], SERIES_FEATURES, Y, min_rows=8, model_type="customer", core=CORE
    )


@query("M04_by_pattern")
def _(t):
    train, test = sku_halves(t)
    return models.by_pattern(train, test, ["sku"], SERIES_FEATURES, Y, aggregates.pattern_v31(train, ["sku"]))


@query("M04_gbt_cyclical")
def _(t):
    return models.gbt_cyclical(*sku_halves(t), ["sku"], FEATURES, Y, q_aggregates.patterns(t))


@query("M05_winsorised_target")
def _(t):
    train, test = sku_halves(t)
    clipped = winsorise(train, ["sku"], Y, name="weekly_quantity_raw")
    clipped = clipped.withColumn(Y, F.col("weekly_quantity_raw")).drop("weekly_quantity_raw")
    return models.gbt_global(clipped, test, ["sku"], FEATURES, Y, core=CORE)


@query("M05_winsorised_by_sku")
def _(t):
    return models.winsorised_by_entity(*sku_halves(t), ["sku"], SERIES_FEATURES, Y, core=CORE)


@query("M06_linear")
def _(t):
    return models.linear(*sku_halves(t), ["sku"], FEATURES, Y, core=CORE)


@query(
    "M06_ridge_by_category",
    """
    WITH s AS (SELECT category, COUNT(*) AS n, AVG(lag1) AS m1, AVG(avg_unit_price) AS m2, AVG(y) AS my, regr_sxx(lag1, lag1) + 0.1 AS a, regr_sxx(avg_unit_price, avg_unit_price) + 0.1 AS d,
                 regr_sxy(lag1, avg_unit_price) AS b, regr_sxy(y, lag1) AS u, regr_sxy(y, avg_unit_price) AS v FROM x_train GROUP BY category),
    c AS (SELECT *, (u * d - b * v) / (a * d - b * b) AS slope_lag1, (a * v - b * u) / (a * d - b * b) AS slope_price FROM s)
    SELECT category, n, my - slope_lag1 * m1 - slope_price * m2 AS intercept, slope_lag1, slope_price FROM c""",
    "intercept slope_lag1 slope_price",
)
def _(t):
    # moments by week, as a table that later ranges of weeks can use, then summed to the categories
    feats = ["lag1", "avg_unit_price"]
    weekly = pin(moments.moments(models.complete_rows(group_halves(t)[0], CORE), feats, Y, ["category", "year_week"]))
    table = moments.ridge(moments.merged(weekly, 3, ["category"]), feats, 0.1, ["category"])
    return table.select("category", "n", "intercept", F.get("slopes", F.lit(0)).alias("slope_lag1"), F.get("slopes", F.lit(1)).alias("slope_price"))


@query(
    "M07_arima_eligible",
    """
    WITH ok AS (SELECT * FROM x_sku WHERE year_week IN (SELECT year_week FROM x_completeness WHERE v2 = 'complete')),
    e AS (SELECT * FROM ok WHERE sku IN (SELECT sku FROM ok GROUP BY sku HAVING COUNT(*) >= 20))
    SELECT sku, year_week, weekly_quantity FROM e WHERE sku IN (SELECT sku FROM e GROUP BY sku ORDER BY SUM(weekly_quantity) DESC, sku LIMIT 50)""",
    "weekly_quantity",
)
def _(t):
    weekly = pin(t.sku_week().select("sku", "year_week", Y))
    return models.arima_eligible(weekly, ["sku"], Y, 20, 50, aggregates.week_completeness(t.raw_lines()))


@query("M07_auto_arima_sku")
def _(t):
    return models.auto_arima(t.weekly("sku").select("sku", "year_week", Y), ["sku"], Y)


@query("M07_auto_arima_category")
def _(t):
    return models.auto_arima(t.weekly("category").select("category", "year_week", Y), ["category"], Y, h=8, level=0.95, holiday_weeks=(52, 1))


def customer_weeks(t: Sales):
    """SKU x customer weeks with the customer's segment and buyer type."""
    lines = t.raw_lines()
    weekly = aggregates.weekly_features(lines, ["sku", "customer_id"], {"order_count": "invoice_id"}, drop_blank="customer_id")
    dim = customers.customer_cycles(lines).select("customer_id", "buyer_type", "total_units")
    # the tables' customers buy far less than the rule's usual limits
    units = F.col("total_units")
    segment = customers.segment_v2(units, units, bulk=(100_000, 100_000), large=1200, medium=800)
    dim = dim.withColumn("customer_segment", segment).drop("total_units")
    return weekly.join(dim, "customer_id")


PARTS["x_customer_weeks"] = f"""
    SELECT w.*, buyer_type, CASE WHEN total_units > 1200 THEN 'Large Retailer' WHEN total_units > 800 THEN 'Medium Retailer' ELSE 'Small Retailer' END AS customer_segment
    FROM (SELECT sku, customer_id, year_week, SUM(quantity) AS weekly_quantity, SUM(line_total) AS weekly_revenue, AVG(unit_price) AS avg_unit_price,
                 COUNT(DISTINCT invoice_id) AS order_count FROM x_raw WHERE customer_id <> '' GROUP BY 1, 2, 3) w
    JOIN (SELECT customer_id, total_units, {q_aggregates.BUYER_SQL} AS buyer_type FROM x_customer_stats) USING (customer_id)"""


@query(
    "M08_segment_features",
    """
    SELECT sku, customer_id, year_week, weekly_quantity, CASE customer_segment WHEN 'Small Retailer' THEN 1 WHEN 'Medium Retailer' THEN 2 ELSE 3 END AS segment_code,
           CASE buyer_type WHEN 'Occasional Buyer' THEN 1 WHEN 'Regular Buyer' THEN 2 WHEN 'Frequent Buyer' THEN 3 WHEN 'High-Value Buyer' THEN 4 ELSE 5 END AS buyer_type_code,
           CAST(substr(year_week, 7, 2) AS INTEGER) AS week_of_year, CAST(month(monday) AS INTEGER) AS month
    FROM x_customer_weeks JOIN x_monday USING (year_week) WHERE weekly_quantity > 0""",
    "weekly_quantity",
)
def _(t):
    df = models.segment_features(customer_weeks(t))
    return df.select("sku", "customer_id", "year_week", Y, "segment_code", "buyer_type_code", "week_of_year", "month")


@query(
    "M08_segment_series",
    """
    WITH s AS (SELECT customer_id, year_week, SUM(weekly_quantity) AS weekly_quantity FROM x_customer_weeks
               WHERE customer_segment IN ('Medium Retailer', 'Large Retailer') AND weekly_quantity > 0 GROUP BY 1, 2)
    SELECT * FROM s WHERE customer_id IN (SELECT customer_id FROM s GROUP BY 1 HAVING COUNT(*) >= 4)""",
    "weekly_quantity",
)
def _(t):
    return models.segment_series(customer_weeks(t), ["Medium Retailer", "Large Retailer"], 4)


@query("M08_segment_forecast")
def _(t):
    series = pin(models.segment_series(customer_weeks(t), ["Medium Retailer", "Large Retailer"], 4))
    return models.auto_arima(series, ["customer_id"], Y, min_weeks=8)


@query("M08_segment_model")
def _(t):
    feats = ["avg_unit_price", "order_count", "segment_code", "buyer_type_code", "week_of_year", "month"]
    # the fit reads its rows several times and the scores once more: they are written once
    rows = models.segment_features(customer_weeks(t)).select("sku", "customer_id", "year_week", *feats, Y)
    return models.gbt_global(*baselines.split(pin(rows), CUT), ["sku", "customer_id"], feats, Y)


def cycle_dim(t: Sales):
    return pin(customers.customer_cycles(t.raw_lines()))


CYCLE_FEATURES = ["total_orders", "total_units", "total_revenue", "avg_order_value", "active_weeks", "avg_days_between_orders"]


@query("M09_cycle_classifier")
def _(t):
    return models.cycle_classifier(cycle_dim(t), CYCLE_FEATURES)


@query(
    "M10_elasticity_features",
    """
    WITH h AS (SELECT *, LAG(avg_price) OVER (PARTITION BY sku ORDER BY year_week) AS prev_avg_price FROM x_price_history),
    q AS (SELECT *, LAG(weekly_quantity) OVER (PARTITION BY sku ORDER BY year_week) AS prev_quantity, (avg_price - prev_avg_price) / prev_avg_price * 100 AS price_change_pct
          FROM h WHERE prev_avg_price > 0)
    SELECT sku, year_week, price_change_pct, avg_price, prev_avg_price, weekly_quantity, prev_quantity, (weekly_quantity - prev_quantity) / prev_quantity * 100 AS quantity_change_pct
    FROM q WHERE prev_quantity > 0 AND abs(price_change_pct) > 0.1""",
    "price_change_pct avg_price prev_avg_price weekly_quantity prev_quantity quantity_change_pct",
)
def _(t):
    return models.elasticity_features(aggregates.price_history(t.raw_lines()))


@query(
    "M10_log_elasticity",
    """
    SELECT sku, regr_slope(ln(weekly_quantity), ln(avg_price)) AS elasticity, COUNT(*) AS n_weeks FROM x_price_history
    WHERE avg_price > 0 AND weekly_quantity > 0 GROUP BY sku HAVING COUNT(*) >= 8""",
    "elasticity",
)
def _(t):
    return models.log_elasticity(aggregates.price_history(t.raw_lines()))


@query("M10_elasticity_model")
def _(t):
    rows = models.elasticity_features(aggregates.price_history(t.raw_lines()))
    feats = ["price_change_pct", "avg_price", "prev_avg_price", "prev_quantity"]
    label = "quantity_change_pct"
    model = models.fit(rows.where(~models.held_out("sku")), feats, label)
    return models.score(model, rows.where(models.held_out("sku")), feats, floor=False).select("sku", "year_week", "price_change_pct", "predicted", label)


@query("M11_regional_revenue")
def _(t):
    from ..operators import windows

    df = q_aggregates.region_week(t)
    df = windows.lags(df, ["region_name"], "week_start", "weekly_revenue", (1, 2, 4), "revenue_lag_")
    df = windows.share(df, ["week_start"], "weekly_revenue", "revenue_share")
    df = windows.rank_in(df, ["week_start"], "weekly_revenue", name="revenue_rank")
    feats = ["revenue_lag_1", "revenue_lag_2", "revenue_lag_4", "transaction_count", "unique_customers", "week_of_year", "month"]
    # sequential split: the last fifth of the weeks is the test part
    weeks = df.select("week_start").distinct()
    cut = weeks.agg(F.percentile(F.unix_date("week_start"), 0.8).alias("_cut"))
    marked = df.crossJoin(F.broadcast(cut)).withColumn("_test", F.unix_date("week_start") > F.col("_cut")).drop("_cut")
    train, test = marked.where(~F.col("_test")), marked.where("_test")
    model = models.fit(train, feats, "weekly_revenue", iters=50)
    return models.score(model, test, feats).select("week_start", "region_name", "predicted", "weekly_revenue", "revenue_share", "revenue_rank")


PARTS["x_revenue"] = """
    SELECT sku, year_week, SUM(quantity) AS quantity, SUM(line_total) AS revenue, COUNT(DISTINCT invoice_id) AS num_orders FROM x_lines GROUP BY 1, 2"""


def revenue_week(t: Sales):
    return t.lines().groupBy("sku", "year_week").agg(
        F.sum("quantity").alias("quantity"), F.sum("line_total").alias("revenue"), F.count_distinct("invoice_id").alias("num_orders")
    )


@query(
    "M12_sku_revenue_features",
    """
    WITH f AS (SELECT r.*, LAG(revenue, 1) OVER w AS revenue_lag_1, LAG(revenue, 2) OVER w AS revenue_lag_2, LAG(revenue, 3) OVER w AS revenue_lag_3,
                 LAG(revenue, 4) OVER w AS revenue_lag_4, CAST(week(monday) AS INTEGER) AS week_of_year, CAST(month(monday) AS INTEGER) AS month, CAST(quarter(monday) AS INTEGER) AS quarter,
                 AVG(revenue) OVER p AS revenue_rolling_mean_4, stddev_samp(revenue) OVER p AS revenue_rolling_std_4, LAG(quantity) OVER w AS quantity_lag_1, LAG(num_orders) OVER w AS orders_lag_1
               FROM x_revenue r JOIN (SELECT year_week AS yw, monday FROM x_monday) ON r.year_week = yw
               WINDOW w AS (PARTITION BY sku ORDER BY year_week), p AS (PARTITION BY sku ORDER BY year_week ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING))
    SELECT * FROM f WHERE revenue_lag_4 IS NOT NULL""",
    "quantity revenue revenue_lag_1 revenue_lag_2 revenue_lag_3 revenue_lag_4 revenue_rolling_mean_4 revenue_rolling_std_4 quantity_lag_1",
)
def _(t):
    return models.sku_revenue_features(revenue_week(t))


@query("M12_sku_revenue_model")
def _(t):
    # both encodings read the features twice, and the fit and the scores read the encoded rows: each is written once
    rows = pin(models.sku_revenue_features(revenue_week(t)))
    rows = rows.join(t.products().select("sku", "category"), "sku")
    rows = pin(models.encode(models.encode(rows, rows, "sku"), rows, "category"))
    feats = [c for c in rows.columns if c.startswith(("revenue_", "quantity_lag", "orders_lag"))]
    feats += ["sku_encoded", "category_encoded", "week_of_year", "month", "quarter"]
    train, test = rows.where(F.col("year_week") <= CUT), rows.where(F.col("year_week") > CUT)
    return models.gbt_global(train, test, ["sku"], feats, "revenue", iters=200, depth=6)


@query(
    "M12_scored_rows",
    """
    WITH f AS (SELECT *, LAG(revenue, 4) OVER (PARTITION BY sku ORDER BY year_week) AS lag4 FROM x_revenue)
    SELECT COUNT(*) AS n_rows, COUNT(DISTINCT sku) AS n_entities, SUM(revenue) AS total FROM f WHERE lag4 IS NOT NULL AND year_week > '1998-W26'""",
    "total",
)
def _(t):
    rows = pin(models.sku_revenue_features(revenue_week(t)))
    train, test = rows.where(F.col("year_week") <= CUT), rows.where(F.col("year_week") > CUT)
    preds = models.gbt_global(train, test, ["sku"], ["revenue_lag_1", "revenue_lag_2"], "revenue", iters=1)
    return preds.agg(F.count("predicted").alias("n_rows"), F.count_distinct("sku").alias("n_entities"), F.sum("actual").alias("total"))


@query("M13_what_if")
def _(t):
    train, test = (models.complete_rows(half, CORE) for half in brand_halves(t))
    model = models.fit(train, FEATURES, Y)
    cheaper = test.withColumn("avg_unit_price", F.col("avg_unit_price") * 0.9)
    base = models.score(model, test, FEATURES).select("brand", "year_week", F.col("predicted").alias("predicted_base"))
    changed = models.score(model, cheaper, FEATURES).select("brand", "year_week", F.col("predicted").alias("predicted_cheaper"))
    return base.join(changed, ["brand", "year_week"])


@query("M14_importance")
def _(t):
    return models.importance(models.fit(sku_halves(t)[0], FEATURES, Y, CORE), FEATURES)


@query(
    "M15_ts_splits",
    """
    WITH w AS (SELECT year_week, row_number() OVER (ORDER BY year_week) - 1 AS i, COUNT(*) OVER () AS n FROM (SELECT DISTINCT year_week FROM x_lines)),
    f AS (SELECT *, n // 4 AS size, unnest([1, 2, 3]) AS fold FROM w),
    r AS (SELECT CAST(fold AS INTEGER) AS fold, year_week, CASE WHEN i < n - (4 - fold) * size THEN 'train' WHEN i < n - (3 - fold) * size THEN 'test' END AS role FROM f)
    SELECT * FROM r WHERE role IS NOT NULL""",
)
def _(t):
    return models.ts_splits(t.lines())


@query("M15_ts_cv")
def _(t):
    rows = models.model_features(t.brand_week(), ["brand"])
    return models.ts_cv(rows, ["brand"], FEATURES, Y, SETTINGS, splits=3, core=CORE)


@query(
    "M15_cv_rows",
    """
    WITH w AS (SELECT year_week, row_number() OVER (ORDER BY year_week) - 1 AS i, COUNT(*) OVER () AS n FROM (
                 SELECT DISTINCT year_week FROM (SELECT year_week, LAG(weekly_quantity, 4) OVER (PARTITION BY brand ORDER BY year_week) AS lag4 FROM x_brand) WHERE lag4 IS NOT NULL)),
    f AS (SELECT *, n // 4 AS size, unnest([1, 2, 3]) AS fold FROM w),
    r AS (SELECT fold, year_week, CASE WHEN i < n - (4 - fold) * size THEN 'train' WHEN i < n - (3 - fold) * size THEN 'test' END AS role FROM f),
    b AS (SELECT year_week FROM (SELECT year_week, LAG(weekly_quantity, 4) OVER (PARTITION BY brand ORDER BY year_week) AS lag4 FROM x_brand) WHERE lag4 IS NOT NULL),
    s(iters, depth, step) AS (VALUES (100, 4, 0.1::DOUBLE), (200, 6, 0.1::DOUBLE), (300, 8, 0.05::DOUBLE))
    SELECT iters, depth, step, CAST(fold AS INTEGER) AS fold, COUNT(*) FILTER (role = 'train') AS n_train, COUNT(*) FILTER (role = 'test') AS n_test
    FROM s, r JOIN b USING (year_week) GROUP BY ALL""",
    "step",
)
def _(t):
    rows = models.model_features(t.brand_week(), ["brand"])
    return models.cv_rows(rows, SETTINGS, splits=3, core=CORE)


@query("M16_exclude_weeks", "SELECT sku, year_week, weekly_quantity FROM x_sku WHERE week_num <> 47", Y)
def _(t):
    return models.exclude_weeks(t.sku_week().select("sku", "year_week", Y), [47])


@query(
    "M17_ensemble",
    """
    WITH b AS (SELECT brand, CASE WHEN AVG(weekly_quantity) > 175 THEN 'cyclical' ELSE 'high_variance' END AS pattern FROM x_brand GROUP BY brand)
    SELECT brand, year_week, pattern, CASE pattern WHEN 'cyclical' THEN n.predicted * 0.4 + m.predicted * 0.6 ELSE n.predicted * 0.3 + m.predicted * 0.7 END AS predicted, n.actual
    FROM x_naive_brand n JOIN x_ma_brand m USING (brand, year_week) JOIN b USING (brand)""",
    "predicted actual",
)
def _(t):
    kind = F.when(F.avg(Y) > 175, "cyclical").otherwise("high_variance").alias("pattern")
    patterns = t.weekly("brand").groupBy("brand").agg(kind)
    weights = {"cyclical": {"naive": 0.4, "ma4": 0.6}, "other": {"naive": 0.3, "ma4": 0.7}}
    return models.ensemble({"naive": naive_brand(t), "ma4": ma_brand(t)}, weights, patterns, ["brand"], "other")


@query(
    "M18_model_summary",
    """
    SELECT COUNT(*) AS n_series, AVG(mae) AS mean_mae, AVG(mse) AS mean_mse, AVG(wmape) AS mean_wmape FROM (
      SELECT sku, AVG(abs(actual - predicted)) AS mae, AVG(pow(actual - predicted, 2)) AS mse, SUM(abs(actual - predicted)) * 100 / SUM(actual) AS wmape FROM x_ma_sku GROUP BY sku)""",
    "mean_mae mean_mse mean_wmape",
)
def _(t):
    return models.model_summary(q_aggregates.ma_sku(t), ["sku"])


@query("M18_classifier_metrics")
def _(t):
    return models.classifier_metrics(models.cycle_classifier(cycle_dim(t), CYCLE_FEATURES))


