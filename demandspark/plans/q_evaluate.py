"""Evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import week_num
from ..operators import baselines, evaluate, windows
from . import q_aggregates
from .q_joins import brand, halves, ma_brand, naive_brand, per_sku
from .registry import CUT, PARTS, query

ERR = "abs(actual - predicted) * 100 / NULLIF(actual, 0)"
METRICS = f"""COUNT(*) AS n_predictions, AVG(abs(actual - predicted)) AS mae, sqrt(AVG(pow(actual - predicted, 2))) AS rmse,
       AVG({ERR}) AS mean_mape, CASE WHEN SUM(actual) > 0 THEN SUM(abs(actual - predicted)) * 100 / SUM(actual) ELSE 999.0 END AS wmape,
       AVG(predicted - actual) AS bias"""
METRIC_COLUMNS = "mae rmse mean_mape wmape bias median_mape"

PARTS["x_models"] = """
    SELECT brand, year_week, actual, predicted, 'naive' AS model FROM x_naive_brand
    UNION ALL SELECT brand, year_week, actual, predicted, 'ma4' FROM x_ma_brand
    UNION ALL SELECT brand, year_week, weekly_quantity, p, 'week26' FROM x_brand
      JOIN (SELECT brand, AVG(weekly_quantity) AS p FROM x_brand WHERE week_num = 26 AND year_week <= '1998-W26' GROUP BY brand) USING (brand) WHERE year_week > '1998-W26'"""


def models(t):
    return {
        "naive": naive_brand(t),
        "ma4": ma_brand(t),
        "week26": baselines.naive_at_week(*halves(t), ["brand"], "weekly_quantity"),
    }


for zero in ("null", "zero"):

    @query(
        f"V01_errors_{zero}",
        f"""
        SELECT sku, year_week, actual, predicted, predicted - actual AS error, abs(actual - predicted) AS abs_error,
               {ERR if zero == 'null' else f'COALESCE({ERR}, 0)'} AS pct_error
        FROM (SELECT sku, year_week, CASE WHEN actual < 10 THEN 0 ELSE actual END AS actual, predicted FROM x_ma_sku)""",
        "actual predicted error abs_error pct_error",
    )
    def _(t, zero=zero):
        preds = q_aggregates.ma_sku(t).withColumn("actual", F.when(F.col("actual") < 10, 0.0).otherwise(F.col("actual")))
        return evaluate.errors(preds, zero)


@query(
    "V02_metrics",
    f"SELECT {METRICS}, COUNT(DISTINCT sku) AS entities, median({ERR}) AS median_mape FROM x_ma_sku",
    METRIC_COLUMNS,
)
def _(t):
    return evaluate.metrics(q_aggregates.ma_sku(t), e="sku")


@query(
    "V02_metrics_sold",
    f"SELECT {METRICS}, median({ERR}) AS median_mape FROM x_ma_sku WHERE actual > 0",
    METRIC_COLUMNS,
)
def _(t):
    return evaluate.metrics(q_aggregates.ma_sku(t), only_sold=True)


@query(
    "V03_wmape",
    """
    SELECT brand, CASE WHEN SUM(a) > 0 THEN SUM(abs(a - predicted)) * 100 / SUM(a) ELSE 999.0 END AS wmape_999,
           CASE WHEN SUM(a) > 0 THEN SUM(abs(a - predicted)) * 100 / SUM(a) ELSE 0.0 END AS wmape_0,
           CASE WHEN SUM(abs(a)) > 0 THEN SUM(abs(a - predicted)) * 100 / SUM(abs(a)) ELSE 999.0 END AS wmape_abs
    FROM (SELECT brand, predicted, CASE WHEN brand < 'Brand#15' THEN -actual ELSE actual END AS a FROM x_ma_brand) GROUP BY brand""",
    "wmape_999 wmape_0 wmape_abs",
)
def _(t):
    a = F.when(F.col("brand") < "Brand#15", -F.col("actual")).otherwise(F.col("actual"))
    preds = ma_brand(t).withColumn("actual", a)
    pair = (F.col("actual"), F.col("predicted"))
    return preds.groupBy("brand").agg(
        evaluate.wmape(*pair).alias("wmape_999"),
        evaluate.wmape(*pair, empty=0.0).alias("wmape_0"),
        evaluate.wmape(*pair, denom="abs").alias("wmape_abs"),
    )


@query(
    "V04_per_entity",
    f"""
    SELECT sku, COUNT(*) AS n_weeks, AVG(abs(actual - predicted)) AS mae, median({ERR}) AS median_mape, AVG({ERR}) AS mean_mape,
           SUM(abs(actual - predicted)) * 100 / SUM(actual) AS wmape, SUM(actual) AS total_actual, SUM(predicted) AS total_predicted FROM x_ma_sku GROUP BY sku""",
    "mae median_mape mean_mape wmape total_actual total_predicted",
)
def _(t):
    return evaluate.per_entity(q_aggregates.ma_sku(t), ["sku"])


PARTS["x_sliced"] = """
    SELECT *, CASE WHEN substr(year_week, 7, 2) = '47' THEN 'W47' WHEN substr(year_week, 7, 2) >= '45' THEN 'holiday' ELSE 'other' END AS slice
    FROM x_ma_sku JOIN (SELECT sku, pattern FROM x_pattern) USING (sku)"""


@query(
    "V05_sliced",
    f"SELECT slice, pattern, {METRICS}, median({ERR}) AS median_mape FROM x_sliced GROUP BY slice, pattern",
    METRIC_COLUMNS,
)
def _(t):
    w = week_num("year_week")
    preds = q_aggregates.ma_sku(t).join(q_aggregates.patterns(t).select("sku", "pattern"), "sku")
    sliced = preds.withColumn("slice", F.when(w == 47, "W47").when(w >= 45, "holiday").otherwise("other"))
    return evaluate.metrics(sliced, ["slice", "pattern"])


@query(
    "V06_compare",
    f"""
    WITH m AS (SELECT model, {METRICS}, COUNT(DISTINCT brand) AS entities, median({ERR}) AS median_mape FROM x_models GROUP BY model)
    SELECT *, CAST(model = (SELECT arg_min(model, mae) FROM m) AS INTEGER) AS is_best FROM m""",
    METRIC_COLUMNS,
)
def _(t):
    return evaluate.compare(models(t), "brand")


@query(
    "V07_compare_versions",
    """
    WITH m AS (SELECT model AS model_version, COUNT(*) AS n_predictions, SUM(abs(actual - predicted)) * 100 / SUM(actual) AS wmape FROM x_models GROUP BY 1)
    SELECT *, wmape - LAG(wmape) OVER (ORDER BY model_version) AS delta_wmape FROM m""",
    "wmape delta_wmape",
)
def _(t):
    return evaluate.compare_versions(models(t))


PARTS["x_labelled"] = """
    SELECT sku, wmape, COALESCE(h1_weeks, 0) AS h1_weeks, CASE WHEN wmape < 40 AND h1_weeks >= 15 THEN 'High' WHEN wmape < 60 AND h1_weeks >= 10 THEN 'Medium' ELSE 'Low' END AS confidence
    FROM x_per_sku LEFT JOIN (SELECT sku, COUNT(*) AS h1_weeks FROM x_sku WHERE year_week <= '1998-W26' GROUP BY sku) USING (sku)"""


def labelled(t):
    per = per_sku(t).select("sku", "wmape")
    weeks = windows.train_weeks(baselines.split(t.weekly("sku"), CUT)[0], ["sku"])
    return evaluate.with_confidence(per, weeks, ["sku"])


@query("V08_confidence", "SELECT * FROM x_labelled", "wmape")
def _(t):
    return labelled(t)


@query(
    "V08_confidence_variants",
    """
    SELECT sku, CASE WHEN wmape < 40 THEN 'High' WHEN wmape < 60 THEN 'Medium' ELSE 'Low' END AS category_label,
           CASE WHEN wmape < 40 THEN 'High' WHEN wmape < 80 THEN 'Medium' ELSE 'Low' END AS customer_label,
           CASE WHEN wmape < 40 AND n_weeks >= 20 THEN 'High' WHEN wmape < 70 AND n_weeks >= 10 THEN 'Medium' ELSE 'Low' END AS config_label FROM x_per_sku""",
)
def _(t):
    w, n = F.col("wmape"), F.col("n_weeks")
    return per_sku(t).select(
        "sku",
        evaluate.confidence(w, variant="category").alias("category_label"),
        evaluate.confidence(w, variant="customer").alias("customer_label"),
        evaluate.confidence(w, n, "config").alias("config_label"),
    )


@query(
    "V08_confidence_distribution",
    "SELECT confidence, COUNT(*) AS entities, AVG(wmape) AS avg_wmape FROM x_labelled GROUP BY confidence",
    "avg_wmape",
)
def _(t):
    return evaluate.confidence_distribution(labelled(t))


@query(
    "V09_accuracy_tier",
    """
    SELECT CASE WHEN wmape > 0 AND wmape <= 20 THEN 'Excellent (<20%)' WHEN wmape > 20 AND wmape <= 40 THEN 'Good (20-40%)'
        WHEN wmape > 40 AND wmape <= 60 THEN 'Fair (40-60%)' WHEN wmape > 60 AND wmape <= 100 THEN 'Poor (60-100%)'
        WHEN wmape > 100 AND wmape <= 1000 THEN 'Very Poor (>100%)' END AS accuracy_tier, COUNT(*) AS entities FROM x_per_sku GROUP BY 1""",
)
def _(t):
    tiers = per_sku(t).groupBy(evaluate.accuracy_tier(F.col("wmape")).alias("accuracy_tier"))
    return tiers.agg(F.count("*").alias("entities"))


@query(
    "V10_threshold_counts",
    "SELECT COUNT(*) AS entities, COUNT(*) FILTER (wmape < 20) AS under_20, COUNT(*) FILTER (wmape < 40) AS under_40, COUNT(*) FILTER (wmape > 100) AS over_100 FROM x_per_sku",
)
def _(t):
    return evaluate.threshold_counts(per_sku(t))


@query("V11_bias", "SELECT model, AVG(predicted - actual) AS bias FROM x_models GROUP BY model", "bias")
def _(t):
    from ..operators.joins import union_all

    return evaluate.bias(union_all(models(t), "model"), ["model"])


PARTS["x_direction"] = """
    SELECT *, LAG(actual) OVER (PARTITION BY brand ORDER BY year_week) AS prev FROM x_ma_brand"""


@query(
    "V12_monitor",
    f"""
    SELECT brand, COUNT(*) AS n_rows, AVG(abs(actual - predicted)) AS mae, sqrt(AVG(pow(actual - predicted, 2))) AS rmse, AVG({ERR}) AS mape,
           SUM(abs(actual - predicted)) * 100 / SUM(actual) AS wmape,
           AVG(CASE WHEN prev IS NOT NULL THEN CAST(sign(actual - prev) = sign(predicted - prev) AS INTEGER) END) AS direction_accuracy,
           AVG(CASE WHEN predicted IS NULL THEN 100.0 ELSE 0.0 END) AS missing_values_pct FROM x_direction GROUP BY brand""",
    "mae rmse mape wmape direction_accuracy missing_values_pct",
)
def _(t):
    return evaluate.monitor(ma_brand(t), ["brand"], ["brand"])


@query(
    "V12_drift",
    """
    WITH r AS (SELECT weekly_quantity AS v FROM x_brand WHERE year_week <= '1998-W26'), c AS (SELECT weekly_quantity AS v FROM x_brand WHERE year_week > '1998-W26'),
    q AS (SELECT unnest(quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS cut FROM r),
    rb AS (SELECT (SELECT COUNT(*) FROM q WHERE cut < v) AS bin, COUNT(*) AS n FROM r GROUP BY 1),
    cb AS (SELECT (SELECT COUNT(*) FROM q WHERE cut < v) AS bin, COUNT(*) AS n FROM c GROUP BY 1),
    j AS (SELECT bin, COALESCE(rb.n, 0) AS rn, COALESCE(cb.n, 0) AS cn FROM rb FULL JOIN cb USING (bin)),
    p AS (SELECT GREATEST(rn, 0.5) / (SELECT SUM(rn) FROM j) AS p, GREATEST(cn, 0.5) / (SELECT SUM(cn) FROM j) AS q FROM j)
    SELECT SUM((q - p) * ln(q / p)) AS psi, COUNT(*) AS bins_used FROM p""",
    "psi",
)
def _(t):
    train, test = halves(t)
    return evaluate.drift(train, test, "weekly_quantity")


@query("V13_share_under", f"SELECT AVG(CASE WHEN m < 50 THEN 1.0 ELSE 0.0 END) AS share_under FROM (SELECT sku, median({ERR}) AS m FROM x_ma_sku GROUP BY sku)", "share_under")
def _(t):
    return evaluate.share_under(evaluate.per_entity(q_aggregates.ma_sku(t), ["sku"]))


def pair(t):
    actual = brand(t).withColumnRenamed("weekly_quantity", "actual")
    return evaluate.side_by_side(actual, naive_brand(t), ma_brand(t), ["brand", "year_week"], ("naive", "ma"))


@query(
    "V14_side_by_side",
    """
    SELECT a.brand, a.year_week, a.weekly_quantity AS actual, n.predicted AS predicted_naive, abs(weekly_quantity - n.predicted) AS naive_abs_error,
           abs(weekly_quantity - n.predicted) / NULLIF(weekly_quantity, 0) AS naive_pct_error, m.predicted AS predicted_ma,
           abs(weekly_quantity - m.predicted) AS ma_abs_error, abs(weekly_quantity - m.predicted) / NULLIF(weekly_quantity, 0) AS ma_pct_error
    FROM x_brand a LEFT JOIN x_naive_brand n USING (brand, year_week) LEFT JOIN x_ma_brand m USING (brand, year_week)""",
    "actual predicted_naive naive_abs_error naive_pct_error predicted_ma ma_abs_error ma_pct_error",
)
def _(t):
    return pair(t)


@query(
    "V14_side_by_side_metrics",
    f"""
    SELECT CASE model WHEN 'ma4' THEN 'ma' ELSE model END AS model, AVG(abs(actual - predicted)) AS mae, sqrt(AVG(pow(actual - predicted, 2))) AS rmse,
           AVG({ERR}) AS mape, SUM(abs(actual - predicted)) * 100 / SUM(actual) AS wmape FROM x_models WHERE model <> 'week26' GROUP BY 1""",
    "mae rmse mape wmape",
)
def _(t):
    return evaluate.side_by_side_metrics(pair(t), ("naive", "ma"))


@query(
    "V15_compare_runs",
    """
    SELECT concat('run-', event_id) AS run_name, event_type AS status, value AS duration_seconds, json_extract_string(props, '$.k') AS param_k,
           CAST(NULL AS VARCHAR) AS param_absent, value * 2 AS metric_mae FROM events""",
    "duration_seconds metric_mae",
)
def _(t):
    events = t.table("events")
    runs = events.select(
        F.concat(F.lit("run-"), "event_id").alias("run_name"),
        F.col("event_type").alias("status"),
        F.col("value").alias("duration_seconds"),
        F.col("props").alias("params"),
        F.to_json(F.struct((F.col("value") * 2).alias("mae"))).alias("metrics"),
    )
    return evaluate.compare_runs(runs, ["k", "absent"], ["mae"])
