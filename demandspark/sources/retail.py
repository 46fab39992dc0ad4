"""Sales lines out of an order/line-item star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import year_week
from ..session import prepare


def with_attributes(lines: DataFrame, dim: DataFrame, key: str, defaults: dict | None = None) -> DataFrame:
    """Every line, with the attributes of its key; lines whose key the dimension lacks take the defaults."""
    defaults = {c: "Unknown" for c in dim.columns if c != key} | (defaults or {})
    joined = lines.join(dim, key, "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(value)) for c, value in defaults.items()})


class Retail:
    """Lazy views over one folder of parquet tables; each method reads only what it needs."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare(spark)
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def customers(self) -> DataFrame:
        """Customers with their region; nation and region are fixed short lists."""
        nation = F.broadcast(self.table("nation"))
        region = F.broadcast(self.table("region"))
        return (
            self.table("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("c_custkey").cast("string").alias("customer_id"),
                F.col("c_name").alias("customer_name"),
                F.col("r_name").alias("region_name"),
                "c_nationkey",
                "c_acctbal",
                "c_mktsegment",
            )
        )

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("sku"),
            F.col("p_name").alias("description"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            F.col("p_retailprice").alias("price"),
            F.concat_ws("/", F.lit("Root"), "p_type", "p_brand", "p_name").alias("category_path"),
        )

    def lines(self, product: bool = False, customer: bool = False) -> DataFrame:
        """Invoice lines; product and customer attributes only on request, `Unknown` where the dimension lacks the key."""
        df = self.order_lines(self.customers().select("customer_id", "customer_name", "region_name") if customer else None)
        if product:
            df = with_attributes(df, self.products().select("sku", "description", "category", "brand"), "sku")
        return df

    def order_lines(self, customers: DataFrame | None = None, defaults: dict | None = None) -> DataFrame:
        """Lines with their order. Customers' attributes go onto the orders, so the lines are not shuffled for them."""
        orders = self.table("orders").select(
            "o_orderkey",
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_custkey").cast("string").alias("customer_id"),
        )
        extra = []
        if customers is not None:
            orders = with_attributes(orders, customers, "customer_id", defaults)
            extra = [c for c in customers.columns if c != "customer_id"]
        total = F.col("l_extendedprice") * (1 - F.col("l_discount"))
        return (
            self.table("lineitem")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.col("l_orderkey").cast("string").alias("invoice_id"),
                F.col("l_linenumber").alias("line_number"),
                "order_date",
                "customer_id",
                F.col("l_partkey").alias("sku"),
                F.col("l_quantity").alias("quantity"),
                (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
                total.alias("line_total"),
                year_week("order_date").alias("year_week"),
                *extra,
            )
        )

    def raw_lines(self, product: bool = False) -> DataFrame:
        """Lines with the defects the cleaning steps repair.

        Line 7 of an order lost price and total, line 6 its price; customers with a
        negative balance lost their id; one region's name is unknown.
        """
        customers = self.customers().select("customer_id", "customer_name", "region_name", "c_acctbal")
        df = self.order_lines(customers, {"c_acctbal": 0.0})
        if product:
            df = with_attributes(df, self.products().select("sku", "description", "category", "brand"), "sku")
        line = F.col("line_number")
        return df.withColumns(
            {
                "unit_price": F.when(line >= 6, 0.0).otherwise(F.col("unit_price")),
                "line_total": F.when(line == 7, 0.0).otherwise(F.col("line_total")),
                "customer_id": F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("customer_id")),
                "region_name": F.when(F.col("region_name") == "MIDDLE EAST", "Unknown").otherwise(
                    F.col("region_name")
                ),
            }
        ).drop("c_acctbal")
