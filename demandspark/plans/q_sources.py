"""Source and sink queries (S01-S14) and the exported-sheet steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import sheets, tables
from .registry import PARTS, Sales, query

PARTS["x_files"] = """
    SELECT DISTINCT region, month, kind, CASE kind
             WHEN 0 THEN concat('ZZ_', region, '_', month, '.xlsx')
             WHEN 1 THEN concat('ZZ_', region, '_', month, '_v2.xlsx')
             WHEN 2 THEN concat('ZZ_', region, '_', month, '-corrected.xlsx')
             WHEN 3 THEN concat('~$ZZ_', region, '_', month, '-corrected.xlsx')
             ELSE concat('dub_', region, '_', month, '_corrected.xlsx') END AS file_name
    FROM (SELECT CASE r_name WHEN 'AFRICA' THEN 'CapeTown' WHEN 'AMERICA' THEN 'Gauteng' WHEN 'ASIA' THEN 'George'
                      WHEN 'EUROPE' THEN 'Limpopo' ELSE 'Other' END AS region,
                 strftime(o_orderdate, '%Y-%m') AS month, LEAST((day(o_orderdate) - 1) // 6, 4) AS kind
          FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
          JOIN region ON n_regionkey = r_regionkey)"""


def files(t: Sales):
    """Monthly file names per region, in several editions, as the orders' months imply them."""
    region = (
        F.when(F.col("region_name") == "AFRICA", "CapeTown")
        .when(F.col("region_name") == "AMERICA", "Gauteng")
        .when(F.col("region_name") == "ASIA", "George")
        .when(F.col("region_name") == "EUROPE", "Limpopo")
        .otherwise("Other")
    )
    day = F.col("invoice_date")
    rows = t.transactions().select(
        region.alias("region"), F.date_format(day, "yyyy-MM").alias("month"), F.least(F.floor((F.dayofmonth(day) - 1) / 6), F.lit(4)).alias("kind")
    ).distinct()
    stem = F.concat_ws("_", F.lit("ZZ"), "region", "month")
    name = (
        F.when(F.col("kind") == 0, F.concat(stem, F.lit(".xlsx")))
        .when(F.col("kind") == 1, F.concat(stem, F.lit("_v2.xlsx")))
        .when(F.col("kind") == 2, F.concat(stem, F.lit("-corrected.xlsx")))
        .when(F.col("kind") == 3, F.concat(F.lit("~$"), stem, F.lit("-corrected.xlsx")))
        .otherwise(F.concat(F.lit("dub_"), F.concat_ws("_", "region", "month"), F.lit("_corrected.xlsx")))
    )
    return rows.withColumn("file_name", name)


@query("S01_csv_inferred", "SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders", "o_totalprice")
def _(t):
    path = scratch_path(t.spark, "csv")
    tables.write_csv(t.table("orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"), path)
    df = tables.read_csv(t.spark, path)
    return df.withColumns({c: F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")})


# Column specification of the customer file.
CUSTOMER_SPEC = [
    {"name": "c_custkey", "type": "INT64", "mode": "REQUIRED"},
    {"name": "c_name", "type": "STRING", "mode": "REQUIRED"},
    {"name": "c_acctbal", "type": "FLOAT64", "mode": "NULLABLE"},
]


@query("S02_csv_schema", "SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer", "c_acctbal")
def _(t):
    path = scratch_path(t.spark, "csv")
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal")
    tables.write_csv(t.table("customer").select("c_custkey", "c_name", balance), path)
    return tables.read_csv(t.spark, path, tables.schema_from_spec(CUSTOMER_SPEC))


@query(
    "S02_required_nulls",
    """
    SELECT 'c_custkey' AS column_name, COUNT(*) - COUNT(c_custkey) AS null_count FROM customer
    UNION ALL SELECT 'c_name', SUM(CAST(c_acctbal < 0 AS BIGINT))::BIGINT FROM customer""",
)
def _(t):
    path = scratch_path(t.spark, "csv")
    name = F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("c_name")
    tables.write_csv(t.table("customer").select("c_custkey", name, "c_acctbal"), path)
    schema = tables.schema_from_spec(CUSTOMER_SPEC)
    return tables.missing_required(tables.read_csv(t.spark, path, schema), schema)


@query("S03_ndjson_roundtrip", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part", "p_retailprice")
def _(t):
    path = scratch_path(t.spark, "json")
    df = t.table("part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    tables.write(df, path, "json")
    return tables.read(t.spark, path, "json", df.schema)


@query("S03_parquet_partitioned", "SELECT p_brand, COUNT(*) AS n FROM part WHERE p_type = 'PROMO' GROUP BY p_brand")
def _(t):
    path = scratch_path(t.spark, "parquet")
    tables.write(t.table("part").select("p_brand", "p_type"), path, partition_by=["p_type"])
    back = tables.read(t.spark, path).where(F.col("p_type") == "PROMO")
    return back.groupBy("p_brand").agg(F.count("*").alias("n"))


@query(
    "S04_select_sources",
    """
    SELECT month, region, file_name FROM (
      SELECT *, row_number() OVER (PARTITION BY month, region ORDER BY
               CASE WHEN file_name LIKE '%corrected%' THEN 0 WHEN file_name LIKE '%v2%' THEN 1 ELSE 2 END, file_name) AS rn
      FROM x_files WHERE kind < 3) WHERE rn = 1""",
)
def _(t):
    return sheets.select_sources(files(t))


@query(
    "S05_region_from_name",
    """
    SELECT DISTINCT file_name, CASE region WHEN 'CapeTown' THEN 'Cape Town' WHEN 'Limpopo' THEN 'Polokwane'
                                    WHEN 'Other' THEN 'Unknown' ELSE region END AS region_name FROM x_files""",
)
def _(t):
    return files(t).select("file_name", sheets.region_from_name("file_name").alias("region_name")).distinct()


@query(
    "S06_classify_sheet",
    """
    SELECT o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 'invoice'
             WHEN o_orderpriority = '1-URGENT' THEN 'summary' WHEN o_orderpriority = '2-HIGH' THEN 'debtors'
             WHEN o_orderpriority = '3-MEDIUM' THEN 'summary' ELSE 'other' END AS kind, COUNT(*) AS n
    FROM orders GROUP BY ALL""",
)
def _(t):
    priority = F.col("o_orderpriority")
    number = (F.col("o_orderkey") + 10_000).cast("string")
    sheet = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.substring(number, 1, 2), F.lit(". "), F.expr("substring(cast(o_orderkey + 10000 as string), 3)")))
        .when(priority == "1-URGENT", F.concat(number, F.lit(" Summary")))
        .when(priority == "2-HIGH", "Debtors Masterfile")
        .when(priority == "3-MEDIUM", F.date_format("o_orderdate", "MMMM yyyy"))
        .otherwise("Sheet1")
    )
    rows = t.table("orders").select("o_orderstatus", sheets.classify_sheet(sheet).alias("kind"))
    return rows.groupBy("o_orderstatus", "kind").agg(F.count("*").alias("n"))


def ragged(t: Sales):
    """Line items as maps of cells whose headers differ by source."""
    qty, price = F.col("l_quantity").cast("int").cast("string"), F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    sku = F.col("l_partkey").cast("string")

    def cells(*pairs):
        return F.create_map(*[x for name, value in pairs for x in (F.lit(name), value)])

    flag = F.col("l_returnflag")
    kind = (
        F.when(flag == "A", cells(("StockCode", sku), ("Qty.", qty), (" Price Incl.", price), ("Line Total", price)))
        .when(flag == "N", cells(("SKU ", sku), ("Description", F.col("l_linestatus")), ("Quantity", qty), ("Total Price", price)))
        .otherwise(cells(("stock_code", sku), ("Quant", qty), ("UNIT PRICE", price)))
    )
    return t.table("lineitem").select("l_orderkey", "l_linenumber", kind.alias("cells"))


@query(
    "S07_resolve_headers",
    """
    SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS sku,
           CASE WHEN l_returnflag = 'N' THEN l_linestatus END AS description,
           CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity,
           CASE WHEN l_returnflag <> 'N' THEN CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) AS VARCHAR) END AS price,
           CASE WHEN l_returnflag <> 'R' THEN CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) AS VARCHAR) END AS total
    FROM lineitem""",
)
def _(t):
    return sheets.resolve_headers(ragged(t))


@query(
    "E10_invoice_header",
    """
    SELECT l_orderkey AS invoice_id, l_linenumber,
           CASE WHEN o_orderstatus = 'P' THEN CAST(date_trunc('month', o_orderdate) AS DATE) ELSE CAST(o_orderdate AS DATE) END AS order_date,
           CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
           CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE c_name END AS customer_name
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
)
def _(t):
    orders, customers = t.table("orders"), t.table("customer")
    day = F.col("o_orderdate").cast("date")
    lines = t.table("lineitem").select(F.col("l_orderkey").alias("invoice_id"), "l_linenumber").join(
        orders.select(F.col("o_orderkey").alias("invoice_id"), F.trunc(day, "month").alias("month_start")), "invoice_id"
    )
    summary = orders.where(F.col("o_orderpriority") != "5-LOW").select(
        F.col("o_orderkey").alias("invoice_id"),
        F.when(F.col("o_orderstatus") != "P", day.cast("string")).alias("order_date"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.lit("").alias("customer_name"),
    ).unionByName(
        orders.where(F.col("o_orderpriority") == "5-LOW").select(
            F.col("o_orderkey").alias("invoice_id"),
            F.when(F.col("o_orderstatus") != "P", day.cast("string")).alias("order_date"),
            F.lit(None).cast("string").alias("customer_id"),
            F.lit(None).cast("string").alias("customer_name"),
        )
    )
    debtors = customers.select(F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("customer_name"))
    return sheets.attach_invoice_header(lines, summary, debtors, F.col("month_start")).drop("month_start")


@query(
    "S08_overwrite_append",
    "SELECT n_regionkey, CAST(COUNT(*) * 2 AS BIGINT) AS n FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_regionkey",
)
def _(t):
    path = scratch_path(t.spark, "table")
    rows = t.table("customer").join(F.broadcast(t.table("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select("c_custkey", "n_regionkey")
    tables.write(rows, path, mode="overwrite")
    tables.write(rows, path, mode="append")
    return tables.read(t.spark, path).groupBy("n_regionkey").agg(F.count("*").alias("n"))


@query(
    "S09_csv_sink",
    "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment FROM customer",
)
def _(t):
    path = scratch_path(t.spark, "csv")
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("c_mktsegment")
    tables.write_csv(t.table("customer").select("c_custkey", segment), path)
    schema = tables.schema_from_spec([{"name": "c_custkey", "type": "INT64"}, {"name": "c_mktsegment", "type": "STRING"}])
    return tables.read_csv(t.spark, path, schema)


@query("S10_view", "SELECT p_type, COUNT(*) AS n, MAX(p_retailprice) AS max_price FROM part GROUP BY p_type", "max_price")
def _(t):
    tables.register("parts_of_sale", t.table("part"))
    return t.spark.sql("SELECT p_type, count(*) AS n, max(p_retailprice) AS max_price FROM parts_of_sale GROUP BY p_type")


@query(
    "S11_with_version",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'V3' ELSE 'V1' END AS model_version FROM orders""",
)
def _(t):
    version = F.when(F.col("o_orderstatus") == "F", "V3").alias("model_version")
    return tables.with_version(t.table("orders").select("o_orderkey", version))


@query(
    "S12_table_counts",
    """
    SELECT 'orders' AS table_name, COUNT(*) AS row_count FROM orders UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem
    UNION ALL SELECT 'customer', COUNT(*) FROM customer UNION ALL SELECT 'part', COUNT(*) FROM part""",
)
def _(t):
    return tables.table_counts({n: t.table(n) for n in ("orders", "lineitem", "customer", "part")})


@query(
    "S13_recent_rows",
    """
    SELECT brand, year_week, weekly_quantity FROM x_brand WHERE year_week >= '2001-W20'
    ORDER BY year_week DESC, weekly_quantity DESC, brand LIMIT 20""",
    "weekly_quantity",
)
def _(t):
    rows = t.brand_week().where(F.col("year_week") >= "2001-W20").select("brand", "year_week", "weekly_quantity")
    return tables.head(rows, 20, F.desc("year_week"), F.desc("weekly_quantity"), "brand")


@query("S14_select_available", "SELECT p_partkey, p_brand FROM part")
def _(t):
    return tables.select_available(t.table("part"), ["p_partkey", "p_brand", "p_manufacturer"])


