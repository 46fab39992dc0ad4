"""Reporting tables read by a dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import period, week_start
from ..functions.clean import safe_div
from ..operators.aggregates import weekly_totals
from ..operators.evaluate import confidence, errors, metrics, per_entity, wmape
from ..operators.joins import union_all

# Texts shown beside a prediction.
SHORT_TEXT = "Insufficient data for prediction"
MARGINAL_TEXT = "Limited historical data"
BULK_TEXT = "Irregular purchasing pattern"
BASELINE_TEXT = "Limited data - using baseline model"


def prediction_view(preds: DataFrame) -> DataFrame:
    """Confidence level and disclaimer of routed predictions."""
    short, marginal = F.col("data_sufficiency") == "insufficient", F.col("data_sufficiency") == "marginal"
    bulk = F.col("pattern") == "bulk_oneoff"
    return preds.withColumns(
        {
            "confidence_level": F.when(short, "none")
            .when(F.col("pattern") == "cyclical", "high")
            .when(bulk, "medium")
            .otherwise("low"),
            "disclaimer": F.when(short, SHORT_TEXT).when(marginal, MARGINAL_TEXT).when(bulk, BULK_TEXT),
        }
    )


def mape_view(preds: DataFrame, e: list[str]) -> DataFrame:
    """Median MAPE, volume and weeks per entity, pattern and version (weekly series)."""
    return (
        errors(preds.where(F.col("actual") > 0))
        .groupBy(*e, "pattern", "data_sufficiency", "model_version")
        .agg(
            F.percentile("pct_error", 0.5).alias("mape"),
            F.sum("actual").alias("total_volume"),
            F.count("*").alias("n_weeks"),
        )
    )


def display_rule(df: DataFrame) -> DataFrame:
    """Whether and how a prediction is shown."""
    short, marginal = F.col("data_sufficiency") == "insufficient", F.col("data_sufficiency") == "marginal"
    full_level = F.when(F.col("pattern") == "bulk_oneoff", "medium").otherwise("high")
    rule = F.struct(
        (~short).alias("show_prediction"),
        F.when(short, None).when(marginal, "V1_baseline").otherwise("V2_optimized").alias("model"),
        F.when(short, SHORT_TEXT).when(marginal, BASELINE_TEXT).alias("disclaimer"),
        F.when(short, None).when(marginal, "low").otherwise(full_level).alias("confidence"),
    )
    return df.withColumn("display", rule)


def week_map(value: str) -> Column:
    """Weeks in order with values to one decimal; at most one entry per calendar week."""
    entry = F.struct(F.col("year_week"), F.round(value, 1).alias("v"))
    return F.map_from_entries(F.sort_array(F.collect_list(entry)))


def series_document(h1: DataFrame, preds: DataFrame, meta: DataFrame, e: list[str], y: str = "weekly_quantity") -> DataFrame:
    """Nested document per entity: training map, actual and predicted maps, metadata, and its JSON.

    `meta` is one row per entity.
    """
    past = h1.groupBy(*e).agg(week_map(y).alias("h1"), F.count("*").alias("_w"), F.round(F.sum(y), 1).alias("_t"))
    ahead = preds.groupBy(*e).agg(
        week_map("actual").alias("_a"),
        week_map("predicted").alias("_p"),
        F.round(wmape(F.col("actual"), F.col("predicted")), 1).alias("_wmape"),
    )
    info = [c for c in meta.columns if c not in e]
    doc = ahead.join(past, e, "left").join(meta, e, "left").select(
        *e,
        "h1",
        F.struct(F.col("_a").alias("actual"), F.col("_p").alias("predicted")).alias("h2"),
        F.struct(
            *info,
            F.col("_wmape").alias("wmape"),
            F.coalesce("_w", F.lit(0)).alias("h1_weeks"),
            F.coalesce("_t", F.lit(0.0)).alias("h1_total"),
        ).alias("meta"),
    )
    return doc.withColumn("document", F.to_json(F.struct("h1", "h2", "meta")))


def series_document_flat(doc: DataFrame, e: list[str]) -> DataFrame:
    """D04 exploded: one row per entity, part and week."""
    parts = F.array(
        F.struct(F.lit("h1").alias("part"), F.col("h1").alias("m")),
        F.struct(F.lit("actual").alias("part"), F.col("h2.actual").alias("m")),
        F.struct(F.lit("predicted").alias("part"), F.col("h2.predicted").alias("m")),
    )
    rows = doc.select(*e, F.explode(parts).alias("p")).select(*e, "p.part", F.explode("p.m").alias("year_week", "value"))
    return rows


def confidence_lists(labelled: DataFrame, e: str) -> DataFrame:
    """Position of each entity in its label's list, best WMAPE first.

    The lists hold every entity, so they are kept as rows with a rank, not as one array.
    """
    from ..functions.distributed import rank_large

    ranked = rank_large(labelled, ["confidence"], "wmape", "list_rank", descending=False)
    return ranked.select("confidence", "list_rank", e, "wmape")


def all_versions(preds_by_version: dict[str, DataFrame], e: str, level: str) -> DataFrame:
    """Aligned predictions of all versions, ids as text."""
    aligned = {
        v: errors(df, "zero").select(
            F.lit(level).alias("level"),
            F.col(e).cast("string").alias("entity_id"),
            "year_week",
            "actual",
            "predicted",
            "abs_error",
            "pct_error",
        )
        for v, df in preds_by_version.items()
    }
    return union_all(aligned, "model_version")


def eval_summary(preds_by_level: dict[str, DataFrame], weeks_by_level: dict[str, DataFrame]) -> DataFrame:
    """Per version and level: predictions, WMAPE, MAE, and entities per confidence label.

    Input tables have the D06 shape; the weeks tables are (entity_id, h1_weeks).
    """
    parts = []
    for level, preds in preds_by_level.items():
        per = per_entity(preds, ["model_version", "entity_id"]).join(weeks_by_level[level], "entity_id", "left")
        label = confidence(F.col("wmape"), F.coalesce("h1_weeks", F.lit(0)), "sku")
        totals = per.withColumn("_l", label).groupBy("model_version").agg(
            F.sum("n_weeks").alias("total_predictions"),
            F.count("*").alias("unique_entities"),
            F.count_if(F.col("_l") == "High").alias("high_confidence"),
            F.count_if(F.col("_l") == "Medium").alias("medium_confidence"),
            F.count_if(F.col("_l") == "Low").alias("low_confidence"),
        )
        scores = preds.groupBy("model_version").agg(
            wmape(F.col("actual"), F.col("predicted")).alias("wmape"),
            F.avg(F.abs(F.col("actual") - F.col("predicted"))).alias("mae"),
        )
        parts.append(totals.join(scores, "model_version").withColumn("level", F.lit(level)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def at_risk(dim: DataFrame, as_of: Column, k: int = 20) -> DataFrame:
    """The largest bulk or high-value buyers with an irregular rhythm."""
    rows = dim.where(
        F.col("buyer_type").isin("Bulk Buyer", "High-Value Buyer") & (F.col("cycle_regularity") == "Irregular")
    )
    return rows.select(
        "customer_id",
        "customer_name",
        "primary_region",
        "buyer_type",
        "avg_days_between_orders",
        "last_order",
        F.datediff(as_of, "last_order").alias("days_since_last_order"),
        "total_revenue",
    ).orderBy(F.desc("total_revenue"), "customer_id").limit(k)


def weekly_summary(completeness: DataFrame) -> DataFrame:
    """The week table as the dashboard shows it."""
    return completeness.select(
        "year_week",
        "invoice_count",
        F.round("total_quantity", 0).alias("total_units"),
        F.round("total_revenue", 0).alias("total_revenue"),
        "unique_skus",
        "unique_customers",
        "data_completeness",
        F.round("price_coverage", 1).alias("price_coverage_pct"),
    )


def predictions_of(df: DataFrame, e: str, key) -> DataFrame:
    """The rows of one entity."""
    return df.where(F.col(e) == F.lit(key))


def h1_actuals(df: DataFrame, e: list[str], y: str = "weekly_quantity", cut: int | str = 26) -> DataFrame:
    """Training actuals of a level."""
    return df.where(period("year_week", cut) == "H1").select(*e, "year_week", y)


def forecast_dataset(lines: DataFrame, e: list[str], cut: int | str = 26) -> DataFrame:
    """Quantity, revenue, orders and customers per entity and week, with Monday and half."""
    weekly = lines.groupBy(*e, "year_week").agg(
        F.sum("quantity").alias("quantity"),
        F.sum("line_total").alias("revenue"),
        F.count_distinct("invoice_id").alias("num_orders"),
        F.count_distinct("customer_id").alias("num_customers"),
    )
    return weekly.withColumns({"period": period("year_week", cut), "date": week_start("year_week")})


def compare_customer_keys(original: DataFrame, normalised: DataFrame) -> DataFrame:
    """Accuracy under the original and the master customer key (column `entity`)."""
    both = union_all({"original": original, "normalised": normalised}, "approach")
    return metrics(both, ["approach"], "entity", only_sold=True).select(
        "approach", "n_predictions", "entities", "median_mape", "mae"
    )


def week_profile(lines: DataFrame) -> DataFrame:
    """Week totals against the week before (one row per week)."""
    weeks = weekly_totals(lines).select("year_week", "total_units")
    previous = F.lag("total_units").over(Window.orderBy("year_week"))
    return weeks.withColumn("prev_units", previous).withColumn(
        "pct_change", safe_div(F.col("total_units") - F.col("prev_units"), "prev_units") * 100
    )
