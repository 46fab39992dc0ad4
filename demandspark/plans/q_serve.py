"""Reporting-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, baselines, customers, windows
from . import q_aggregates, serve
from .q_evaluate import labelled, models
from .q_forecast import routed
from .q_joins import brand, halves, ma_brand
from .registry import PARTS, query


@query(
    "D01_prediction_view",
    """
    SELECT *, CASE WHEN data_sufficiency = 'insufficient' THEN 'none' WHEN pattern = 'cyclical' THEN 'high' WHEN pattern = 'bulk_oneoff' THEN 'medium' ELSE 'low' END AS confidence_level,
           CASE WHEN data_sufficiency = 'insufficient' THEN 'Insufficient data for prediction' WHEN data_sufficiency = 'marginal' THEN 'Limited historical data'
                WHEN pattern = 'bulk_oneoff' THEN 'Irregular purchasing pattern' END AS disclaimer FROM x_routed""",
    "actual predicted",
)
def _(t):
    return serve.prediction_view(routed(t))


@query(
    "D02_mape_view",
    """
    SELECT sku, pattern, data_sufficiency, model_version, median(abs(actual - predicted) * 100 / actual) AS mape, SUM(actual) AS total_volume, COUNT(*) AS n_weeks
    FROM x_routed WHERE actual > 0 GROUP BY ALL""",
    "mape total_volume",
)
def _(t):
    return serve.mape_view(routed(t), ["sku"])


@query(
    "D03_display_rule",
    """
    SELECT sku, data_sufficiency <> 'insufficient' AS show_prediction,
           CASE data_sufficiency WHEN 'insufficient' THEN NULL WHEN 'marginal' THEN 'V1_baseline' ELSE 'V2_optimized' END AS model,
           CASE data_sufficiency WHEN 'insufficient' THEN 'Insufficient data for prediction' WHEN 'marginal' THEN 'Limited data - using baseline model' END AS disclaimer,
           CASE data_sufficiency WHEN 'insufficient' THEN NULL WHEN 'marginal' THEN 'low' ELSE CASE WHEN pattern = 'bulk_oneoff' THEN 'medium' ELSE 'high' END END AS confidence
    FROM x_pattern""",
)
def _(t):
    return serve.display_rule(q_aggregates.patterns(t)).select("sku", "display.*")


def document(t):
    train, _ = halves(t)
    meta = t.products().groupBy("brand").agg(F.min("category").alias("category"))
    return serve.series_document(train, ma_brand(t), meta, ["brand"])


@query("D04_series_document")
def _(t):
    return document(t)


@query(
    "D04_series_document_flat",
    """
    SELECT brand, 'h1' AS part, year_week, round(weekly_quantity, 1) AS value FROM x_brand WHERE year_week <= '1998-W26'
    UNION ALL SELECT brand, 'actual', year_week, round(actual, 1) FROM x_ma_brand UNION ALL SELECT brand, 'predicted', year_week, round(predicted, 1) FROM x_ma_brand""",
    "value",
)
def _(t):
    return serve.series_document_flat(document(t), ["brand"])


@query(
    "D05_confidence_lists",
    "SELECT confidence, sku, round(wmape, 6) AS wmape, rank() OVER (PARTITION BY confidence ORDER BY round(wmape, 6)) AS list_rank FROM x_labelled",
    "wmape",
)
def _(t):
    rows = labelled(t).withColumn("wmape", F.round("wmape", 6))
    return serve.confidence_lists(rows, "sku")


PARTS["x_versions"] = """
    SELECT 'brand' AS level, brand AS entity_id, year_week, actual, predicted, abs(actual - predicted) AS abs_error,
           COALESCE(abs(actual - predicted) * 100 / NULLIF(actual, 0), 0) AS pct_error, model AS model_version FROM x_models"""


def versions(t):
    return serve.all_versions(models(t), "brand", "brand")


@query("D06_all_versions", "SELECT * FROM x_versions", "actual predicted abs_error pct_error")
def _(t):
    return versions(t)


@query(
    "D07_eval_summary",
    """
    WITH w AS (SELECT brand AS entity_id, COUNT(*) AS h1_weeks FROM x_brand WHERE year_week <= '1998-W26' GROUP BY 1),
    p AS (SELECT model_version, entity_id, COUNT(*) AS n, SUM(abs_error) * 100 / SUM(actual) AS wmape FROM x_versions GROUP BY 1, 2),
    l AS (SELECT model_version, n, CASE WHEN wmape < 40 AND h1_weeks >= 15 THEN 'High' WHEN wmape < 60 AND h1_weeks >= 10 THEN 'Medium' ELSE 'Low' END AS c FROM p LEFT JOIN w USING (entity_id)),
    s AS (SELECT model_version, SUM(abs_error) * 100 / SUM(actual) AS wmape, AVG(abs_error) AS mae FROM x_versions GROUP BY 1)
    SELECT model_version, CAST(SUM(n) AS BIGINT) AS total_predictions, COUNT(*) AS unique_entities, COUNT(*) FILTER (c = 'High') AS high_confidence,
           COUNT(*) FILTER (c = 'Medium') AS medium_confidence, COUNT(*) FILTER (c = 'Low') AS low_confidence, MIN(wmape) AS wmape, MIN(mae) AS mae, 'brand' AS level
    FROM l JOIN s USING (model_version) GROUP BY model_version""",
    "wmape mae",
)
def _(t):
    weeks = windows.train_weeks(halves(t)[0], ["brand"]).withColumnRenamed("brand", "entity_id")
    return serve.eval_summary({"brand": versions(t)}, {"brand": weeks})


@query(
    "D08_at_risk",
    """
    SELECT customer_id, customer_name, primary_region, buyer_type, avg_days_between_orders, last_order,
           CAST(DATE '2001-12-31' - last_order AS INTEGER) AS days_since_last_order, total_revenue
    FROM (SELECT s.*, c.* EXCLUDE (customer_id), BUYER AS buyer_type FROM x_customer_stats s JOIN x_cycles c USING (customer_id))
    WHERE buyer_type IN ('Bulk Buyer', 'High-Value Buyer') AND cycle_regularity = 'Irregular' ORDER BY total_revenue DESC, customer_id LIMIT 20""".replace(
        "BUYER AS", f"{q_aggregates.BUYER_SQL} AS"
    ),
    "avg_days_between_orders total_revenue",
)
def _(t):
    return serve.at_risk(customers.customer_cycles(t.raw_lines()), F.lit("2001-12-31").cast("date"))


@query(
    "D09_weekly_summary",
    """
    SELECT year_week, invoice_count, round(total_quantity, 0) AS total_units, round(total_revenue, 0) AS total_revenue, unique_skus, unique_customers,
           v2 AS data_completeness, round(prices_captured * 100.0 / line_count, 1) AS price_coverage_pct FROM x_completeness""",
    "total_units total_revenue price_coverage_pct",
)
def _(t):
    return serve.weekly_summary(aggregates.week_completeness(t.raw_lines()))


@query("D10_predictions_of", "SELECT * FROM x_ma_brand WHERE brand = 'Brand#11'", "actual predicted")
def _(t):
    return serve.predictions_of(ma_brand(t), "brand", "Brand#11")


@query(
    "D11_h1_actuals",
    "SELECT brand, year_week, weekly_quantity FROM x_brand WHERE year_week <= '1998-W26'",
    "weekly_quantity",
)
def _(t):
    return serve.h1_actuals(brand(t), ["brand"], cut="1998-W26")


@query(
    "D12_forecast_dataset",
    """
    SELECT category, year_week, SUM(quantity) AS quantity, SUM(line_total) AS revenue, COUNT(DISTINCT invoice_id) AS num_orders,
           COUNT(DISTINCT customer_id) AS num_customers, CASE WHEN CAST(substr(year_week, 7, 2) AS INTEGER) <= 26 THEN 'H1' ELSE 'H2' END AS period, MIN(monday) AS date
    FROM x_lines JOIN x_monday USING (year_week) GROUP BY category, year_week""",
    "quantity revenue",
)
def _(t):
    return serve.forecast_dataset(t.lines(product=True), ["category"])


PARTS["x_ma_customer"] = """
    SELECT customer_id, year_week, weekly_quantity AS actual, predicted FROM (
      SELECT *, AVG(weekly_quantity) OVER (PARTITION BY customer_id ORDER BY year_week ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS predicted FROM x_customer)
    WHERE week_num > 26 AND predicted IS NOT NULL"""
PARTS["x_master_week"] = """
    SELECT c_nationkey AS master, year_week, SUM(quantity) AS q FROM x_lines JOIN customer ON customer_id = CAST(c_custkey AS VARCHAR) GROUP BY 1, 2"""
PARTS["x_ma_master"] = """
    SELECT CAST(master AS VARCHAR) AS entity, actual, predicted FROM (SELECT master, year_week, q AS actual,
      AVG(q) OVER (PARTITION BY master ORDER BY year_week ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS predicted FROM x_master_week)
    WHERE CAST(substr(year_week, 7, 2) AS INTEGER) > 26 AND predicted IS NOT NULL"""


@query(
    "D13_compare_customer_keys",
    """
    SELECT approach, COUNT(*) AS n_predictions, COUNT(DISTINCT entity) AS entities, median(abs(actual - predicted) * 100 / actual) AS median_mape, AVG(abs(actual - predicted)) AS mae
    FROM (SELECT 'original' AS approach, customer_id AS entity, actual, predicted FROM x_ma_customer UNION ALL SELECT 'normalised', entity, actual, predicted FROM x_ma_master)
    WHERE actual > 0 GROUP BY approach""",
    "median_mape mae",
)
def _(t):
    original = baselines.walk_forward(t.customer_week(), ["customer_id"], "weekly_quantity", "ma")
    masters = t.customers().select("customer_id", F.col("c_nationkey").cast("string").alias("entity"))
    lines = t.lines().join(masters, "customer_id")
    weekly = aggregates.weekly_features(lines, ["entity"], price=False)
    normalised = baselines.walk_forward(weekly, ["entity"], "weekly_quantity", "ma")
    return serve.compare_customer_keys(original.withColumnRenamed("customer_id", "entity"), normalised)


@query(
    "D14_week_profile",
    """
    WITH w AS (SELECT year_week, SUM(quantity) AS total_units FROM x_lines GROUP BY 1)
    SELECT *, LAG(total_units) OVER (ORDER BY year_week) AS prev_units,
           (total_units - LAG(total_units) OVER (ORDER BY year_week)) / LAG(total_units) OVER (ORDER BY year_week) * 100 AS pct_change FROM w""",
    "total_units prev_units pct_change",
)
def _(t):
    return serve.week_profile(t.lines())
