"""Registered queries and the SQL each one is checked against."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.aggregates import weekly_features
from ..session import pin
from ..sources.retail import Retail

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

DIGITS = 4
CUT = "1998-W26"  # the last training week of the registered hold-out queries
NUDGE = 1e-7  # moves exact halves off the rounding edge, the same way on both sides


class Sales(Retail):
    """The weekly tables most queries start from.

    `weekly` writes the quantities of a level once and reads them back: a query that needs
    history, test weeks and patterns of the same series then scans the lines once.
    """

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark, folder)
        self._written: dict[str, DataFrame] = {}

    def weekly(self, level: str) -> DataFrame:
        if level not in self._written:
            whole = getattr(self, f"{level}_week")()
            self._written[level] = pin(whole.select(whole.columns[0], "year_week", "weekly_quantity"))
        return self._written[level]

    def sku_week(self) -> DataFrame:
        return weekly_features(self.lines(), ["sku"], {"order_count": "invoice_id"})

    def brand_week(self) -> DataFrame:
        return weekly_features(self.lines(product=True), ["brand"], {"order_count": "invoice_id"})

    def category_week(self) -> DataFrame:
        return weekly_features(self.lines(product=True), ["category"], {"order_count": "invoice_id"})

    def customer_week(self) -> DataFrame:
        return weekly_features(self.lines(), ["customer_id"], {"order_count": "invoice_id"})

    def transactions(self) -> DataFrame:
        """One row per order with its region: the daily and customer tables' input."""
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("document_no"),
            F.col("o_orderdate").cast("date").alias("invoice_date"),
            F.col("o_custkey").cast("string").alias("account_no"),
            F.col("o_totalprice").alias("total_amount_incl"),
            F.col("o_orderstatus").alias("status"),
        )
        regions = self.customers().select(F.col("customer_id").alias("account_no"), "region_name")
        return orders.join(regions, "account_no")


# Named parts of the SQL; a query's WITH clause holds the parts it mentions.
PARTS = {
    "x_lines": """
        SELECT CAST(l_orderkey AS VARCHAR) AS invoice_id, l_linenumber AS line_number,
               CAST(o_orderdate AS DATE) AS order_date, CAST(o_custkey AS VARCHAR) AS customer_id,
               l_partkey AS sku, l_quantity AS quantity, l_extendedprice / l_quantity AS unit_price,
               l_extendedprice * (1 - l_discount) AS line_total,
               strftime(o_orderdate, '%G-W%V') AS year_week,
               p_name AS description, p_type AS category, p_brand AS brand,
               c_name AS customer_name, r_name AS region_name, c_acctbal
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "x_raw": """
        SELECT * REPLACE (
          CASE WHEN line_number >= 6 THEN 0.0 ELSE unit_price END AS unit_price,
          CASE WHEN line_number = 7 THEN 0.0 ELSE line_total END AS line_total,
          CASE WHEN c_acctbal < 0 THEN '' ELSE customer_id END AS customer_id,
          CASE WHEN region_name = 'MIDDLE EAST' THEN 'Unknown' ELSE region_name END AS region_name)
        FROM x_lines""",
    "x_tx": """
        SELECT o_orderkey AS document_no, CAST(o_orderdate AS DATE) AS invoice_date,
               CAST(o_custkey AS VARCHAR) AS account_no, o_totalprice AS total_amount_incl,
               o_orderstatus AS status, r_name AS region_name
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "x_calendar": """
        SELECT CAST(d AS DATE) AS week_start, strftime(d, '%G-W%V') AS year_week
        FROM (SELECT unnest(generate_series(date_trunc('week', MIN(o_orderdate)), date_trunc('week', MAX(o_orderdate)),
                                            INTERVAL 7 DAY)) AS d FROM orders)""",
    "x_monday": """
        SELECT DISTINCT strftime(o_orderdate, '%G-W%V') AS year_week,
               CAST(date_trunc('week', o_orderdate) AS DATE) AS monday FROM orders""",
    "x_brand": """
        SELECT brand, year_week, SUM(quantity) AS weekly_quantity, SUM(line_total) AS weekly_revenue,
               AVG(unit_price) AS avg_unit_price, COUNT(DISTINCT invoice_id) AS order_count,
               CAST(substr(year_week, 7, 2) AS INTEGER) AS week_num
        FROM x_lines GROUP BY brand, year_week""",
    "x_category": """
        SELECT category, year_week, SUM(quantity) AS weekly_quantity, SUM(line_total) AS weekly_revenue,
               AVG(unit_price) AS avg_unit_price, COUNT(DISTINCT invoice_id) AS order_count,
               CAST(substr(year_week, 7, 2) AS INTEGER) AS week_num
        FROM x_lines GROUP BY category, year_week""",
    "x_sku": """
        SELECT sku, year_week, SUM(quantity) AS weekly_quantity, SUM(line_total) AS weekly_revenue,
               AVG(unit_price) AS avg_unit_price, COUNT(DISTINCT invoice_id) AS order_count,
               CAST(substr(year_week, 7, 2) AS INTEGER) AS week_num
        FROM x_lines GROUP BY sku, year_week""",
    "x_customer": """
        SELECT customer_id, year_week, SUM(quantity) AS weekly_quantity, SUM(line_total) AS weekly_revenue,
               AVG(unit_price) AS avg_unit_price, COUNT(DISTINCT invoice_id) AS order_count,
               CAST(substr(year_week, 7, 2) AS INTEGER) AS week_num
        FROM x_lines GROUP BY customer_id, year_week""",
}


def with_parts(body: str) -> str:
    """Prefix the body with the parts it needs, directly or through other parts."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in PARTS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(PARTS[name])

    visit(body)
    parts = ",\n".join(f"{name} AS ({PARTS[name]})" for name in order_parts(needed))
    if not parts:
        return body
    for opening in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(opening):
            return f"{opening}{parts},\n{body.removeprefix(opening)}"
    return f"WITH {parts}\n{body}"


def order_parts(names: set[str]) -> list[str]:
    done: list[str] = []

    def add(name: str) -> None:
        for other in PARTS:
            if other != name and other in names and re.search(rf"\b{other}\b", PARTS[name]):
                add(other)
        if name not in done:
            done.append(name)

    for name in PARTS:
        if name in names:
            add(name)
    return done


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to four places, so sums in another order compare equal."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(F.col(c) + NUDGE, DIGITS) + F.lit(0.0) for c in doubles})


def query(name: str, sql: str | None = None, num: str = ""):
    """Register a function of `Sales` under `name`; `num` lists the SQL's floating columns."""

    def wrap(build: Callable[[Sales], DataFrame]):
        QUERIES[name] = lambda spark, folder: rounded(build(Sales(spark, folder)))
        if sql:
            text = with_parts(sql.strip())
            cols = ", ".join(f"round({c} + {NUDGE}, {DIGITS}) + 0.0 AS {c}" for c in num.split())
            ORACLE[name] = f"SELECT * REPLACE ({cols}) FROM (\n{text}\n)" if cols else text
        return build

    return wrap
