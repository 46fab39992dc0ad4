"""Customer value, cycles and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import safe_div
from ..functions.distributed import key_join
from ..session import pin


def rfm(df: DataFrame, e: list[str], day: str, doc: str, amount: str) -> DataFrame:
    """Recency, frequency and value against the table's last date."""
    last = df.agg(F.max(F.col(day).cast("date")).alias("_as_of"))
    d = F.col(day).cast("date")
    grouped = df.groupBy(*e).agg(
        F.max(d).alias("last_purchase_date"),
        F.min(d).alias("first_purchase_date"),
        F.count("*").alias("purchase_count"),
        F.sum(amount).alias("lifetime_value"),
        F.avg(amount).alias("avg_order_value"),
        F.stddev_samp(amount).alias("order_value_std"),
        F.min(amount).alias("min_order"),
        F.max(amount).alias("max_order"),
        F.count_distinct(doc).alias("total_transactions"),
    )
    return (
        grouped.crossJoin(F.broadcast(last))
        .withColumns(
            {
                "days_since_last_purchase": F.datediff("_as_of", "last_purchase_date"),
                "customer_tenure_days": F.datediff("_as_of", "first_purchase_date"),
            }
        )
        .withColumn("purchase_frequency", F.col("total_transactions") / (F.col("customer_tenure_days") / 30 + 1))
        .drop("_as_of")
    )


def rfm_spec(df: DataFrame, e: list[str], day: str, doc: str, amount: str, as_of: Column) -> DataFrame:
    """Active months and revenue of the last 30 and 90 days, at an explicit date."""
    d = F.col(day).cast("date")

    def recent(days: int) -> Column:
        return F.sum(F.when(d >= F.date_sub(as_of, days), F.col(amount)).otherwise(0.0))

    grouped = df.groupBy(*e).agg(
        F.max(d).alias("last_purchase_date"),
        F.count_distinct(doc).alias("total_transactions"),
        F.count_distinct(F.trunc(d, "month")).alias("active_months"),
        F.sum(amount).alias("lifetime_value"),
        F.avg(amount).alias("avg_order_value"),
        F.max(amount).alias("max_order_value"),
        F.min(amount).alias("min_order_value"),
        F.stddev_samp(amount).alias("order_value_std"),
        recent(30).alias("revenue_last_30d"),
        recent(90).alias("revenue_last_90d"),
    )
    return grouped.withColumns(
        {
            "days_since_last_purchase": F.datediff(as_of, "last_purchase_date"),
            "avg_transactions_per_month": F.col("total_transactions") / F.col("active_months"),
        }
    )


def with_customer(lines: DataFrame) -> DataFrame:
    """Lines that name a customer; dropped before the shuffle, as blanks would all meet on one key."""
    return lines.where(F.col("customer_id").isNotNull() & (F.col("customer_id") != ""))


def segment_v1(avg_units: Column) -> Column:
    """A21 v1: by units per order."""
    return (
        F.when(avg_units < 500, "Small Retailer")
        .when(avg_units < 5_000, "Medium Retailer")
        .when(avg_units < 50_000, "Large Retailer")
        .otherwise("Bulk/Wholesale")
    )


def segment_v2(
    total_units: Column, avg_units: Column, bulk: tuple[float, float] = (100_000, 10_000), large: float = 2_000, medium: float = 500
) -> Column:
    """A21 v2: by total units or units per order; the limits are those of the rule unless given."""
    return (
        F.when((total_units > bulk[0]) | (avg_units > bulk[1]), "Bulk/Wholesale")
        .when(avg_units > large, "Large Retailer")
        .when(avg_units > medium, "Medium Retailer")
        .otherwise("Small Retailer")
    )


def buyer_type(total_units: Column, avg_value: Column, orders: Column) -> Column:
    """A20."""
    return (
        F.when(total_units > 100_000, "Bulk Buyer")
        .when(avg_value > 50_000, "High-Value Buyer")
        .when(orders >= 40, "Frequent Buyer")
        .when(orders >= 10, "Regular Buyer")
        .otherwise("Occasional Buyer")
    )


def cycle_regularity(gap: Column, spread: Column) -> Column:
    """Order rhythm from mean gap and its population deviation."""
    return (
        F.when(gap.isNull(), "One-time")
        .when((gap <= 7) & (spread < 3), "Weekly")
        .when((gap <= 14) & (spread < 5), "Bi-weekly")
        .when((gap <= 35) & (spread < 10), "Monthly")
        .when(spread > 20, "Irregular")
        .otherwise("Sporadic")
    )


def customer_dim(lines: DataFrame) -> DataFrame:
    """Totals, averages, main region, segment v1 and order frequency."""
    stats = lines.groupBy("customer_id").agg(
        F.count_distinct("invoice_id").alias("total_orders"),
        F.sum("quantity").alias("total_units"),
        F.sum("line_total").alias("total_revenue"),
        F.min("customer_name").alias("customer_name"),
        F.mode("region_name", True).alias("primary_region"),
    )
    orders = F.col("total_orders")
    return stats.withColumns(
        {
            "avg_order_units": safe_div("total_units", "total_orders"),
            "avg_order_value": safe_div("total_revenue", "total_orders"),
        }
    ).withColumns(
        {
            "customer_segment": segment_v1(F.col("avg_order_units")),
            "order_frequency": F.when(orders >= 8, "Weekly")
            .when(orders >= 4, "Bi-weekly")
            .when(orders >= 2, "Monthly")
            .otherwise("Occasional"),
        }
    )


def buying_cycles(lines: DataFrame) -> DataFrame:
    """Mean gap between order days per customer; days are merged before the window."""
    days = with_customer(lines).select("customer_id", F.col("order_date").cast("date").alias("_d")).distinct()
    w = Window.partitionBy("customer_id").orderBy("_d")
    gaps = days.withColumn("_gap", F.datediff("_d", F.lag("_d").over(w)))
    cycles = gaps.groupBy("customer_id").agg(
        F.count("*").alias("order_days"),
        F.avg("_gap").alias("avg_days_between_orders"),
        F.coalesce(F.stddev_pop("_gap"), F.lit(0.0)).alias("std_days_between_orders"),
        F.min("_d").alias("first_order"),
        F.max("_d").alias("last_order"),
    )
    return cycles.withColumn(
        "cycle_regularity", cycle_regularity(F.col("avg_days_between_orders"), F.col("std_days_between_orders"))
    )


def top_items(lines: DataFrame, e: list[str], item: str = "sku", y: str = "quantity", k: int = 5) -> DataFrame:
    """The k best items of each entity as one text, best first; ties by item.

    Items are summed first and the row-number filter lets Spark cut each partition to k
    rows per entity before the shuffle.
    """
    sums = lines.groupBy(*e, item).agg(F.sum(y).alias("_y"))
    rank = F.row_number().over(Window.partitionBy(*e).orderBy(F.desc("_y"), F.asc(item)))
    best = sums.withColumn("_r", rank).where(F.col("_r") <= k)
    entries = F.sort_array(F.collect_list(F.struct("_r", F.col(item).cast("string").alias("i"))))
    return best.groupBy(*e).agg(F.array_join(F.transform(entries, lambda x: x["i"]), ",").alias("top_skus"))


def customer_cycles(lines: DataFrame) -> DataFrame:
    """A19-A22 as one customer dimension.

    Totals, order days and top items all start from the lines' few columns used here, which are written once, so the
    lines and what they were joined from are read once.
    """
    columns = ["customer_id", "customer_name", "region_name", "invoice_id", "order_date", "year_week", "sku", "quantity", "line_total"]
    known = pin(with_customer(lines).select(*columns))
    stats = known.groupBy("customer_id").agg(
        F.min("customer_name").alias("customer_name"),
        F.mode("region_name", True).alias("primary_region"),
        F.count_distinct("invoice_id").alias("total_orders"),
        F.sum("quantity").alias("total_units"),
        F.sum("line_total").alias("total_revenue"),
        F.count_distinct("year_week").alias("active_weeks"),
    )
    joined = stats.join(buying_cycles(known), "customer_id").join(top_items(known, ["customer_id"]), "customer_id")
    units, orders = F.col("total_units"), F.col("total_orders")
    value = safe_div("total_revenue", "total_orders")
    return joined.withColumns(
        {
            "avg_order_value": value,
            "buyer_type": buyer_type(units, value, orders),
            "customer_segment": segment_v2(units, safe_div(units, orders)),
        }
    )


def segment_lines(lines: DataFrame) -> DataFrame:
    """The v2 segment of each line's customer; lines without a customer keep NULL."""
    stats = with_customer(lines).groupBy("customer_id").agg(
        F.sum("quantity").alias("_u"), F.count_distinct("invoice_id").alias("_o")
    )
    labels = stats.select("customer_id", segment_v2(F.col("_u"), safe_div("_u", "_o")).alias("customer_segment"))
    return key_join(lines, labels, ["customer_id"], "left")
