"""Join, top list and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, baselines, evaluate, joins
from ..operators.enrich import with_product_attrs
from . import q_aggregates
from .registry import CUT, PARTS, query

PARTS["x_per_sku"] = """
    SELECT sku, COUNT(*) AS n_weeks, SUM(abs(actual - predicted)) * 100 / SUM(actual) AS wmape, SUM(actual) AS volume FROM x_ma_sku GROUP BY sku"""


def per_sku(t):
    per = evaluate.per_entity(q_aggregates.ma_sku(t), ["sku"])
    return per.select("sku", "n_weeks", "wmape", F.col("total_actual").alias("volume"))


def brand(t):
    return t.weekly("brand").select("brand", "year_week", "weekly_quantity")


@query(
    "J01_match_predictions",
    """
    WITH a AS MATERIALIZED (SELECT sku, year_week, weekly_quantity FROM x_sku), p AS MATERIALIZED (SELECT sku, year_week, predicted FROM x_ma_sku)
    SELECT sku, year_week, weekly_quantity, predicted FROM a JOIN p USING (sku, year_week)""",
    "weekly_quantity predicted",
)
def _(t):
    actual = t.weekly("sku").select("sku", "year_week", "weekly_quantity")
    return joins.match_predictions(actual, q_aggregates.ma_sku(t).drop("actual"), ["sku"])


@query(
    "J02_left_dimension",
    "SELECT sku, year_week, weekly_quantity, p_brand AS brand, pattern FROM x_sku JOIN part ON sku = p_partkey LEFT JOIN (SELECT sku, pattern FROM x_pattern) USING (sku)",
    "weekly_quantity",
)
def _(t):
    weekly = t.weekly("sku").select("sku", "year_week", "weekly_quantity")
    df = with_product_attrs(weekly, t.products(), ["brand"])
    return df.join(q_aggregates.patterns(t).select("sku", "pattern"), "sku", "left")


@query(
    "J03_map_join",
    """
    SELECT o_orderkey, COALESCE(label, 'other') AS label FROM orders LEFT JOIN (VALUES ('F', 'done'), ('O', 'open')) v(s, label) ON o_orderstatus = s""",
)
def _(t):
    from ..functions.clean import map_code

    label = F.coalesce(map_code("o_orderstatus", {"F": "done", "O": "open"}), F.lit("other"))
    return t.table("orders").select("o_orderkey", label.alias("label"))


@query(
    "J04_eligible",
    "SELECT sku, year_week, weekly_quantity FROM x_sku WHERE sku IN (SELECT sku FROM x_sku GROUP BY sku HAVING COUNT(*) >= 30)",
    "weekly_quantity",
)
def _(t):
    return joins.eligible(t.weekly("sku").select("sku", "year_week", "weekly_quantity"), ["sku"], 30)


@query(
    "J05_top_entities",
    """
    SELECT customer_id, year_week, weekly_quantity FROM x_customer WHERE customer_id IN (
      SELECT customer_id FROM x_customer GROUP BY customer_id ORDER BY SUM(weekly_quantity) DESC, customer_id LIMIT 100)""",
    "weekly_quantity",
)
def _(t):
    df = t.weekly("customer").select("customer_id", "year_week", "weekly_quantity")
    return joins.top_entities(df, ["customer_id"], "weekly_quantity", 100)


@query("J06_correlated_count", "SELECT sku, COUNT(DISTINCT region_name) AS regions FROM x_lines GROUP BY sku")
def _(t):
    return joins.related_count(t.lines(customer=True), ["sku"], "region_name", "regions")


@query(
    "J07_scalar_subquery",
    "SELECT brand, SUM(quantity) * 100.0 / (SELECT SUM(quantity) FROM x_lines) AS pct FROM x_lines GROUP BY brand",
    "pct",
)
def _(t):
    lines = t.lines(product=True)
    total = t.table("lineitem").agg(F.sum("l_quantity").alias("total"))
    sums = lines.groupBy("brand").agg(F.sum("quantity").alias("q")).crossJoin(F.broadcast(total))
    return sums.select("brand", (F.col("q") * 100.0 / F.col("total")).alias("pct"))


PARTS["x_naive_brand"] = """
    SELECT brand, year_week, weekly_quantity AS actual, p AS predicted FROM x_brand
    JOIN (SELECT brand, arg_max(weekly_quantity, year_week) AS p FROM x_brand WHERE year_week <= '1998-W26' GROUP BY brand) USING (brand) WHERE year_week > '1998-W26'"""
PARTS["x_ma_brand"] = """
    SELECT brand, year_week, weekly_quantity AS actual, p AS predicted FROM x_brand JOIN (
      SELECT brand, AVG(weekly_quantity) AS p FROM (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY year_week DESC) AS rn
        FROM x_brand WHERE year_week <= '1998-W26') WHERE rn <= 4 GROUP BY brand HAVING COUNT(*) >= 4) USING (brand) WHERE year_week > '1998-W26'"""


def halves(t):
    return baselines.split(brand(t), CUT)


def naive_brand(t):
    return baselines.naive_last(*halves(t), ["brand"], "weekly_quantity", baselines.IN_TIME)


def ma_brand(t, n: int = 4):
    return baselines.moving_average(*halves(t), ["brand"], "weekly_quantity", n, baselines.IN_TIME)


@query(
    "J08_multiway_left",
    """
    SELECT a.brand, a.year_week, a.weekly_quantity AS actual, n.predicted AS predicted_naive, m.predicted AS predicted_ma
    FROM x_brand a LEFT JOIN x_naive_brand n USING (brand, year_week) LEFT JOIN x_ma_brand m USING (brand, year_week)""",
    "actual predicted_naive predicted_ma",
)
def _(t):
    actual = brand(t).withColumnRenamed("weekly_quantity", "actual")
    table = evaluate.side_by_side(actual, naive_brand(t), ma_brand(t), ["brand", "year_week"], ("naive", "ma"))
    return table.select("brand", "year_week", "actual", "predicted_naive", "predicted_ma")


@query(
    "J09_on_good_weeks",
    "SELECT brand, year_week, weekly_quantity FROM x_brand WHERE year_week IN (SELECT year_week FROM x_completeness WHERE v2 IN ('complete', 'partial'))",
    "weekly_quantity",
)
def _(t):
    return joins.on_good_weeks(brand(t), aggregates.week_completeness(t.raw_lines()))


@query(
    "J10_full_outer",
    """
    WITH r AS (SELECT region_name, SUM(quantity) AS raw_qty FROM x_lines GROUP BY 1),
    e AS (SELECT region_name, SUM(quantity) AS extracted_qty FROM x_raw GROUP BY 1)
    SELECT region_name, COALESCE(raw_qty, 0) AS raw_qty, COALESCE(extracted_qty, 0) AS extracted_qty FROM r FULL JOIN e USING (region_name)""",
    "raw_qty extracted_qty",
)
def _(t):
    from ..operators.quality import reconcile_by

    return reconcile_by(t.lines(customer=True), t.raw_lines()).select("region_name", "raw_qty", "extracted_qty")


@query(
    "J11_calendar_anti",
    """
    SELECT year_week FROM (SELECT DISTINCT year_week FROM x_lines)
    WHERE year_week NOT IN (SELECT year_week FROM x_lines WHERE category = 'PROMO' GROUP BY 1 HAVING COUNT(*) > 30)""",
)
def _(t):
    lines = t.lines(product=True)
    busy = lines.where(F.col("category") == "PROMO").groupBy("year_week").agg(F.count("*").alias("n")).where(F.col("n") > 30)
    return lines.select("year_week").distinct().join(busy, "year_week", "left_anti")


@query(
    "J12_compare_history",
    """
    WITH r AS (SELECT brand, SUM(weekly_quantity) AS recent_total FROM x_brand WHERE year_week >= '2001-W28' GROUP BY brand),
    f AS (SELECT brand, SUM(predicted) AS forecast_total FROM x_ma_brand WHERE year_week >= '2001-W28' GROUP BY brand)
    SELECT brand, recent_total, forecast_total, (forecast_total - recent_total) / NULLIF(recent_total, 0) * 100 AS growth_pct FROM r JOIN f USING (brand)""",
    "recent_total forecast_total growth_pct",
)
def _(t):
    recent = brand(t).where(F.col("year_week") >= "2001-W28").groupBy("brand").agg(F.sum("weekly_quantity").alias("recent_total"))
    ahead = ma_brand(t).where(F.col("year_week") >= "2001-W28").groupBy("brand").agg(F.sum("predicted").alias("forecast_total"))
    return joins.compare_history(recent, ahead, ["brand"])


@query("K01_multi_sort", "SELECT brand, year_week, weekly_quantity FROM x_brand ORDER BY brand, year_week DESC", "weekly_quantity")
def _(t):
    return brand(t).orderBy("brand", F.desc("year_week"))


@query(
    "K02_sort_by_case",
    """
    SELECT o_orderpriority, COUNT(*) AS n, CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '1-URGENT' THEN 1 ELSE 2 END AS sort_key
    FROM orders GROUP BY 1 ORDER BY 3, 1""",
)
def _(t):
    counts = t.table("orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return joins.sort_by_case(counts, "o_orderpriority", ["5-LOW", "1-URGENT"], "o_orderpriority")


for order, direction in (("best", "ASC"), ("worst", "DESC")):

    @query(
        f"K03_{order}",
        f"SELECT sku, n_weeks, round(wmape, 6) AS wmape, volume FROM x_per_sku ORDER BY round(wmape, 6) {direction}, sku LIMIT 10",
        "wmape volume",
    )
    def _(t, order=order):
        per = per_sku(t).withColumn("wmape", F.round("wmape", 6))
        return joins.best_worst(per, "wmape", 10, order, ["sku"])


@query(
    "K04_top_by_volume",
    "SELECT sku, SUM(weekly_quantity) AS total_units FROM x_sku GROUP BY sku ORDER BY 2 DESC, sku LIMIT 20",
    "total_units",
)
def _(t):
    sums = t.lines().groupBy("sku").agg(F.sum("quantity").alias("total_units"))
    return joins.best_worst(sums, "total_units", 20, "worst", ["sku"])


@query(
    "K05_problem_entities",
    "SELECT sku, n_weeks, wmape, volume FROM x_per_sku WHERE volume > (SELECT median(volume) FROM x_per_sku) AND wmape > 50",
    "wmape volume",
)
def _(t):
    return joins.problem_entities(per_sku(t))


@query(
    "K06_union_all",
    "SELECT brand, year_week, actual, predicted, 'naive' AS model FROM x_naive_brand UNION ALL SELECT brand, year_week, actual, predicted, 'ma4' FROM x_ma_brand",
    "actual predicted",
)
def _(t):
    return joins.union_all({"naive": naive_brand(t), "ma4": ma_brand(t)}, "model")


@query(
    "K07_stack_actual_forecast",
    """
    SELECT brand, year_week, weekly_quantity AS units, 'actual' AS data_type FROM x_brand
    UNION ALL SELECT brand, year_week, predicted, 'forecast' FROM x_ma_brand""",
    "units",
)
def _(t):
    actual = brand(t).withColumnRenamed("weekly_quantity", "units")
    return joins.stack_actual_forecast(actual, ma_brand(t).select("brand", "year_week", F.col("predicted").alias("units")))


@query(
    "K08_keep_first",
    """
    SELECT p_name, p_partkey, p_brand FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn FROM part) WHERE rn = 1""",
)
def _(t):
    return joins.keep_first(t.table("part").select("p_name", "p_partkey", "p_brand"), ["p_name"], ["p_partkey"])
