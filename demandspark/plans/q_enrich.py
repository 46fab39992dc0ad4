"""Enrichment and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import enrich, quality
from ..session import pin
from .registry import PARTS, Sales, query

PARTS["x_avg_price"] = """
    SELECT sku, AVG(line_total / quantity) AS avg_price FROM x_raw WHERE line_total / quantity > 0 GROUP BY sku"""

# Products of one type have no list price, so some lost lines find no reference at all.
PARTS["x_priced"] = """
    SELECT r.* EXCLUDE (unit_price, line_total), r.unit_price AS original_unit_price, r.line_total AS original_line_total,
      CASE WHEN r.unit_price = 0 AND r.line_total = 0 THEN COALESCE(avg_price, master, r.unit_price)
           WHEN r.unit_price = 0 AND r.line_total > 0 THEN r.line_total / r.quantity ELSE r.unit_price END AS unit_price,
      CASE WHEN r.unit_price = 0 AND r.line_total = 0 THEN COALESCE(r.quantity * COALESCE(avg_price, master), r.line_total)
           ELSE r.line_total END AS line_total,
      CASE WHEN r.unit_price = 0 AND r.line_total = 0 THEN
             CASE WHEN avg_price IS NOT NULL THEN 'inferred_from_sku_avg' WHEN master IS NOT NULL THEN 'inferred_from_master'
                  ELSE 'missing_no_reference' END
           WHEN r.unit_price = 0 AND r.line_total > 0 THEN 'has_total_no_unit_price' ELSE 'original' END AS price_source,
      (r.unit_price = 0 AND r.line_total = 0 AND (avg_price IS NOT NULL OR master IS NOT NULL))
        OR (r.unit_price = 0 AND r.line_total > 0) AS price_inferred
    FROM x_raw r LEFT JOIN x_avg_price a ON r.sku = a.sku
    LEFT JOIN (SELECT p_partkey, p_retailprice AS master FROM part WHERE p_type <> 'PROMO') ON r.sku = p_partkey"""

PARTS["x_scored"] = """
    SELECT *, CASE WHEN dq_score <= 50 THEN 'poor' WHEN dq_score <= 70 THEN 'fair' WHEN dq_score <= 90 THEN 'good' ELSE 'excellent' END AS dq_tier
    FROM (SELECT *, GREATEST(100 - CASE WHEN price_inferred THEN 10 ELSE 0 END
             - CASE WHEN unit_price = 0 AND line_total = 0 THEN 30 ELSE 0 END
             - CASE WHEN region_name = 'Unknown' THEN 20 ELSE 0 END
             - CASE WHEN customer_id = '' THEN 10 ELSE 0 END, 0) AS dq_score FROM x_priced)"""

# A lookup whose ids repeat: the customer's master under its own name, and under the segment's name.
PARTS["x_lookup"] = """
    SELECT CAST(c_custkey AS VARCHAR) AS original_customer_id, c_name AS customer_name,
           CAST(c_nationkey * 10 + 1 AS BIGINT) AS master_customer_id FROM customer WHERE c_mktsegment <> 'BUILDING'
    UNION ALL
    SELECT CAST(c_custkey AS VARCHAR), c_mktsegment, CAST(c_nationkey * 10 + 2 AS BIGINT) FROM customer WHERE c_acctbal > 5000"""


def priced(t: Sales, parted: bool = True):
    master = t.products().where(F.col("category") != "PROMO").select("sku", "price")
    return enrich.infer_prices(t.raw_lines(), master, parted)


def scored(t: Sales, parted: bool = True):
    return enrich.dq_score(priced(t, parted))


def lookup(t: Sales):
    customers = t.table("customer")
    key, nation = F.col("c_custkey").cast("string").alias("original_customer_id"), F.col("c_nationkey").cast("bigint")
    own = customers.where(F.col("c_mktsegment") != "BUILDING").select(
        key, F.col("c_name").alias("customer_name"), (nation * 10 + 1).alias("master_customer_id")
    )
    other = customers.where(F.col("c_acctbal") > 5000).select(
        key, F.col("c_mktsegment").alias("customer_name"), (nation * 10 + 2).alias("master_customer_id")
    )
    return own.unionByName(other)


@query(
    "E01_infer_prices",
    """
    SELECT price_source, price_inferred, year_week, COUNT(*) AS n, SUM(unit_price) AS price_sum, SUM(line_total) AS total_sum,
           SUM(original_line_total) AS original_sum
    FROM x_priced GROUP BY ALL""",
    "price_sum total_sum original_sum",
)
def _(t):
    return priced(t).groupBy("price_source", "price_inferred", "year_week").agg(
        F.count("*").alias("n"),
        F.sum("unit_price").alias("price_sum"),
        F.sum("line_total").alias("total_sum"),
        F.sum("original_line_total").alias("original_sum"),
    )


@query(
    "E01_infer_prices_rows",
    """
    SELECT invoice_id, line_number, sku, quantity, unit_price, line_total, price_source FROM x_priced
    WHERE price_source <> 'original'""",
    "quantity unit_price line_total",
)
def _(t):
    df = priced(t).where(F.col("price_source") != "original")
    return df.select("invoice_id", "line_number", "sku", "quantity", "unit_price", "line_total", "price_source")


@query(
    "E02_infer_prices_median",
    """
    SELECT invoice_id, line_number, r.sku, quantity,
           CASE WHEN unit_price = 0 AND line_total = 0 THEN med ELSE unit_price END AS unit_price,
           CASE WHEN line_total = 0 THEN quantity * CASE WHEN unit_price = 0 THEN med ELSE unit_price END ELSE line_total END AS line_total
    FROM x_raw r LEFT JOIN (SELECT sku, quantile_cont(unit_price, 0.5) AS med FROM x_raw WHERE unit_price > 0 GROUP BY sku) m ON r.sku = m.sku""",
    "quantity unit_price line_total",
)
def _(t):
    df = enrich.infer_prices_median(t.raw_lines())
    return df.select("invoice_id", "line_number", "sku", "quantity", "unit_price", "line_total")


@query(
    "E03_enrichment_summary",
    """
    SELECT *, (1 - remaining_zero_revenue / truly_missing_revenue) * 100 AS enrichment_rate,
           revenue_after - revenue_before AS revenue_increase, (revenue_after - revenue_before) * 100 / revenue_before AS revenue_increase_pct
    FROM (SELECT COUNT(*) AS line_items, COUNT(*) FILTER (original_unit_price = 0) AS original_zero_price,
           COUNT(*) FILTER (original_unit_price = 0 AND original_line_total = 0) AS truly_missing_revenue,
           COUNT(*) FILTER (original_unit_price = 0 AND original_line_total > 0) AS had_total_but_no_price,
           COUNT(*) FILTER (price_source = 'inferred_from_sku_avg') AS inferred_from_sku,
           COUNT(*) FILTER (price_source = 'inferred_from_master') AS inferred_from_master,
           COUNT(*) FILTER (unit_price = 0 AND line_total = 0) AS remaining_zero_revenue,
           SUM(original_line_total) AS revenue_before, SUM(line_total) AS revenue_after FROM x_priced)""",
    "revenue_before revenue_after enrichment_rate revenue_increase revenue_increase_pct",
)
def _(t):
    return enrich.enrichment_summary(priced(t))


@query(
    "E04_provenance_flags",
    """
    SELECT CASE WHEN region_name = 'Unknown' THEN 'unknown_unfixable' ELSE 'original' END AS region_source,
           CASE WHEN customer_id = '' THEN 'missing' ELSE 'original' END AS customer_source, COUNT(*) AS n
    FROM x_raw GROUP BY ALL""",
)
def _(t):
    flags = enrich.provenance_flags(t.raw_lines())
    return flags.groupBy("region_source", "customer_source").agg(F.count("*").alias("n"))


@query("E05_dq_score", "SELECT invoice_id, line_number, sku, dq_score, dq_tier FROM x_scored")
def _(t):
    return scored(t).select("invoice_id", "line_number", "sku", "dq_score", "dq_tier")


@query(
    "E06_tier_distribution",
    "SELECT dq_tier, COUNT(*) AS row_count, COUNT(*) * 100.0 / (SELECT COUNT(*) FROM x_scored) AS share_pct FROM x_scored GROUP BY dq_tier",
    "share_pct",
)
def _(t):
    return enrich.tier_distribution(scored(t))


@query(
    "E07_customer_map",
    """
    SELECT customer_id, customer_name, row_number() OVER (ORDER BY length(customer_id), customer_id, customer_name) AS master_customer_id
    FROM (SELECT concat(c_mktsegment, ' ', c_nationkey) AS customer_name, CAST(MIN(c_custkey) AS VARCHAR) AS customer_id
          FROM customer GROUP BY 1)""",
)
def _(t):
    named = t.table("customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.concat_ws(" ", "c_mktsegment", "c_nationkey").alias("customer_name"),
    )
    return enrich.build_customer_map(named)


@query(
    "E08_normalise_customers",
    """
    WITH by_id AS (SELECT original_customer_id AS oid, MIN((master_customer_id, customer_name)) AS m FROM x_lookup GROUP BY 1),
    by_name AS (SELECT original_customer_id AS oid, customer_name AS cname, MIN(master_customer_id) AS m FROM x_lookup GROUP BY 1, 2)
    SELECT invoice_id, line_number, sku, customer_id,
           CASE WHEN n.m IS NOT NULL THEN customer_name ELSE COALESCE(i.m[2], customer_name) END AS customer_name,
           COALESCE(n.m, i.m[1], TRY_CAST(customer_id AS BIGINT)) AS master_customer_id
    FROM x_raw LEFT JOIN by_id i ON customer_id = i.oid
    LEFT JOIN by_name n ON customer_id = n.oid AND customer_name = n.cname""",
)
def _(t):
    df = enrich.normalise_customers(t.raw_lines(), lookup(t))
    return df.select("invoice_id", "line_number", "sku", "customer_id", "customer_name", "master_customer_id")


@query(
    "E09_master_summary",
    """
    SELECT master_customer_id, string_agg(customer_id, ',' ORDER BY customer_id) AS original_ids, COUNT(*) AS num_ids, SUM(q) AS total_volume
    FROM (SELECT c_nationkey AS master_customer_id, customer_id, SUM(quantity) AS q
          FROM x_lines JOIN customer ON customer_id = CAST(c_custkey AS VARCHAR) GROUP BY 1, 2) GROUP BY 1""",
    "total_volume",
)
def _(t):
    masters = t.customers().select("customer_id", F.col("c_nationkey").alias("master_customer_id"))
    return enrich.master_summary(t.lines().join(masters, "customer_id"))


@query(
    "E09_master_ids",
    """
    WITH i AS (SELECT c_nationkey AS master_customer_id, customer_id, SUM(quantity) AS volume
               FROM x_lines JOIN customer ON customer_id = CAST(c_custkey AS VARCHAR) GROUP BY 1, 2)
    SELECT *, COUNT(*) OVER (PARTITION BY master_customer_id) AS num_ids, SUM(volume) OVER (PARTITION BY master_customer_id) AS total_volume FROM i""",
    "volume total_volume",
)
def _(t):
    masters = t.customers().select("customer_id", F.col("c_nationkey").alias("master_customer_id"))
    return enrich.master_ids(t.lines().join(masters, "customer_id"))


@query(
    "E11_product_attrs",
    """
    SELECT sku, year_week, weekly_quantity, CASE WHEN p_type = 'PROMO' THEN 'Unknown' ELSE p_brand END AS brand,
           CASE WHEN p_type = 'PROMO' THEN 'Unknown' ELSE p_type END AS category
    FROM x_sku JOIN part ON sku = p_partkey""",
    "weekly_quantity",
)
def _(t):
    products = t.products().where(F.col("category") != "PROMO")
    weekly = t.sku_week().select("sku", "year_week", "weekly_quantity")
    return enrich.with_product_attrs(weekly, products, ["brand", "category"])


@query(
    "E12_product_dim",
    """
    SELECT p_partkey AS sku, p_name AS name, CASE WHEN p_type = 'PROMO' THEN 'Unknown' ELSE p_brand END AS brand,
           CASE WHEN p_type = 'PROMO' THEN 'Unknown' ELSE p_type END AS category_l1,
           CASE WHEN p_type = 'PROMO' THEN 'Unknown' ELSE p_brand END AS category_l2,
           CASE WHEN p_type = 'PROMO' THEN 'Unknown' ELSE p_name END AS category_l3,
           CAST(p_type <> 'PROMO' AS INTEGER) AS in_master
    FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)""",
)
def _(t):
    products = t.products().where(F.col("category") != "PROMO")
    return enrich.product_dim(t.lines(product=True), products)


@query(
    "E13_quality_counters",
    """
    SELECT COUNT(*) FILTER (sku IS NULL) AS null_skus, COUNT(*) FILTER (quantity IS NULL) AS null_quantities,
           COUNT(*) FILTER (quantity = 0) AS zero_quantities, COUNT(*) FILTER (quantity < 0) AS negative_quantities,
           COUNT(*) FILTER (unit_price IS NULL) AS null_prices, COUNT(*) FILTER (unit_price = 0) AS zero_prices,
           COUNT(*) FILTER (region_name = 'Unknown') AS unknown_region_count, COUNT(*) FILTER (customer_id = '' OR customer_id IS NULL) AS empty_customer_ids
    FROM x_raw""",
)
def _(t):
    return quality.quality_counters(t.raw_lines())


@query(
    "E14_profile_columns",
    """
    WITH src AS (SELECT CASE WHEN c_acctbal < 0 THEN concat('HB_', c_custkey) ELSE CAST(c_custkey AS VARCHAR) END AS customer_id,
                   CASE WHEN c_mktsegment = 'BUILDING' THEN 'None' WHEN c_mktsegment = 'FURNITURE' THEN concat('[', c_name, ']') ELSE c_name END AS name,
                   CASE WHEN c_nationkey = 3 THEN CAST('inf' AS DOUBLE) WHEN c_nationkey <> 4 THEN c_acctbal END AS balance,
                   CASE WHEN c_nationkey = 5 THEN '1998/26' ELSE '1998-W26' END AS year_week FROM customer)
    SELECT 'customer_id' AS column_name, COUNT(*) - COUNT(customer_id) AS null_count, CAST(0 AS BIGINT) AS list_syntax_count,
           CAST(0 AS BIGINT) AS inf_count, CAST(0 AS BIGINT) AS null_word_count,
           COUNT(*) FILTER (regexp_matches(customer_id, '^\\d+\\.?\\d*$')) AS numeric_id_count,
           COUNT(*) FILTER (regexp_matches(customer_id, '^[A-Za-z_]')) AS alpha_id_count, CAST(0 AS BIGINT) AS bad_week_count, 0 AS bad_name FROM src
    UNION ALL SELECT 'full name', 0, COUNT(*) FILTER (name LIKE '[%]'), 0, COUNT(*) FILTER (lower(name) IN ('nan', 'none', 'null')), 0, 0, 0, 1 FROM src
    UNION ALL SELECT 'balance', COUNT(*) - COUNT(balance), 0, COUNT(*) FILTER (isinf(balance)), 0, 0, 0, 0, 0 FROM src
    UNION ALL SELECT 'year_week', 0, 0, 0, 0, 0, 0, COUNT(*) FILTER (NOT regexp_matches(year_week, '^\\d{4}-W\\d{2}$')), 0 FROM src""",
)
def _(t):
    key, segment, nation = F.col("c_custkey").cast("string"), F.col("c_mktsegment"), F.col("c_nationkey")
    src = t.table("customer").select(
        F.when(F.col("c_acctbal") < 0, F.concat(F.lit("HB_"), key)).otherwise(key).alias("customer_id"),
        F.when(segment == "BUILDING", "None")
        .when(segment == "FURNITURE", F.concat(F.lit("["), "c_name", F.lit("]")))
        .otherwise(F.col("c_name"))
        .alias("full name"),
        F.when(nation == 3, float("inf")).when(nation != 4, F.col("c_acctbal")).alias("balance"),
        F.when(nation == 5, "1998/26").otherwise("1998-W26").alias("year_week"),
    )
    return quality.profile_columns(src)


@query(
    "E15_fingerprint",
    """
    SELECT 'sales' AS table_name, COUNT(*) AS row_count, CAST(13 AS BIGINT) AS column_count, COUNT(DISTINCT sku) AS unique_skus,
           COUNT(DISTINCT invoice_id) AS unique_invoices, COUNT(DISTINCT customer_id) AS unique_customers,
           COUNT(DISTINCT category) AS unique_categories, COUNT(DISTINCT region_name) AS unique_regions,
           COUNT(DISTINCT year_week) AS unique_weeks, MIN(year_week) AS first_week, MAX(year_week) AS last_week,
           MIN(order_date) AS first_date, MAX(order_date) AS last_date, SUM(quantity) AS total_quantity, SUM(line_total) AS total_revenue
    FROM x_raw""",
    "total_quantity total_revenue",
)
def _(t):
    lines = t.raw_lines(product=True).select(
        "invoice_id", "line_number", "order_date", "customer_id", "sku", "quantity", "unit_price", "line_total",
        "year_week", "description", "category", "brand", "region_name",
    )
    return quality.fingerprint(lines, "sales")


@query("E15_content_hash")
def _(t):
    return quality.content_hash(t.table("lineitem"))


# a row's text: each value with its length before it, six decimals, microseconds
ROW_TEXT = " || ".join(
    f"COALESCE(length({v}) || ':' || {v}, '-')"
    for v in (
        *(f"CAST({c} AS VARCHAR)" for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")),
        *(f"CAST(CAST({c} AS DECIMAL(28, 6)) AS VARCHAR)" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
        "l_linestatus",
        "CAST(epoch_us(l_shipdate) AS VARCHAR)",
    )
)
HASH_COLUMNS = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_linestatus l_shipdate".split()
HASH_SUMS = ", ".join(f"CAST(SUM(CAST('0x' || substr(d, {1 + 15 * k}, 15) AS HUGEINT)) % 2305843009213693951 AS BIGINT) AS h{k}" for k in range(4))


@query(
    "E15_multiset_hash",
    f"""
    WITH r AS (SELECT l_returnflag, sha256({ROW_TEXT}) AS d FROM lineitem)
    SELECT l_returnflag AS part, COUNT(*) AS n_rows, {HASH_SUMS} FROM r GROUP BY l_returnflag
    UNION ALL SELECT 'all', COUNT(*), {HASH_SUMS} FROM r
    UNION ALL SELECT 'all but R', COUNT(*), {HASH_SUMS} FROM r WHERE l_returnflag <> 'R'""",
)
def _(t):
    # the lines are read once; the whole, and the whole without a part, come from the parts' hashes
    parts = pin(quality.multiset_hash(t.table("lineitem"), ["l_returnflag"], HASH_COLUMNS).withColumnRenamed("l_returnflag", "part"))
    whole = quality.combined(parts).withColumn("part", F.lit("all"))
    without = quality.combined(parts, parts.where("part = 'R'")).withColumn("part", F.lit("all but R"))
    return parts.unionByName(whole).unionByName(without)


@query(
    "E16_describe",
    "SELECT column_name, COUNT(v) AS value_count, COUNT(*) - COUNT(v) AS null_count, AVG(v) AS mean, stddev_samp(v) AS std, MIN(v) AS min, MAX(v) AS max, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75 FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {e} AS v FROM lineitem"
        for c, e in (
            ("l_quantity", "l_quantity"),
            ("l_extendedprice", "l_extendedprice"),
            ("l_discount", "CASE WHEN l_discount > 0 THEN l_discount END"),
        )
    )
    + ") GROUP BY column_name",
    "mean std min max q25 q50 q75",
)
def _(t):
    discount = F.when(F.col("l_discount") > 0, F.col("l_discount"))
    df = t.table("lineitem").withColumn("l_discount", discount)
    return quality.describe(df, ["l_quantity", "l_extendedprice", "l_discount"])


RECONCILE_SQL = """
    WITH r AS (SELECT COUNT(*) AS line_items, COUNT(DISTINCT invoice_id) AS invoices, SUM(quantity) AS quantity, SUM(line_total) AS revenue FROM x_lines),
    e AS (SELECT COUNT(*) AS line_items, COUNT(DISTINCT invoice_id) AS invoices, SUM(quantity) AS quantity, SUM(line_total) AS revenue FROM x_raw WHERE unit_price > 0),
    both_ AS (SELECT 'line_items' AS metric, CAST(r.line_items AS DOUBLE) AS raw_value, CAST(e.line_items AS DOUBLE) AS extracted_value FROM r, e
      UNION ALL SELECT 'invoices', r.invoices, e.invoices FROM r, e UNION ALL SELECT 'quantity', r.quantity, e.quantity FROM r, e
      UNION ALL SELECT 'revenue', r.revenue, e.revenue FROM r, e),
    p AS (SELECT *, extracted_value - raw_value AS diff, round(extracted_value / raw_value * 100, 2) AS pct FROM both_)
    SELECT *, CASE WHEN pct >= 99 THEN 'ok' WHEN pct >= 95 THEN 'warning' WHEN pct = 0 THEN 'new' ELSE 'failed' END AS status FROM p"""


@query("E17_reconcile", RECONCILE_SQL, "raw_value extracted_value diff pct")
def _(t):
    return quality.reconcile(t.lines(), t.raw_lines().where(F.col("unit_price") > 0))


@query(
    "E17_reconcile_region",
    """
    WITH r AS (SELECT region_name, SUM(quantity) AS raw_qty FROM x_lines GROUP BY 1),
    e AS (SELECT region_name, SUM(quantity) AS extracted_qty FROM x_raw WHERE unit_price > 0 GROUP BY 1),
    j AS (SELECT region_name, COALESCE(raw_qty, 0) AS raw_qty, COALESCE(extracted_qty, 0) AS extracted_qty FROM r FULL JOIN e USING (region_name)),
    p AS (SELECT *, extracted_qty - raw_qty AS diff, CASE WHEN raw_qty > 0 THEN round(extracted_qty * 100 / raw_qty, 2) WHEN extracted_qty > 0 THEN 100.0 ELSE 0.0 END AS pct FROM j)
    SELECT *, CASE WHEN pct >= 99 THEN 'ok' WHEN pct >= 95 THEN 'warning' WHEN pct = 0 THEN 'new' ELSE 'failed' END AS status FROM p""",
    "raw_qty extracted_qty diff pct",
)
def _(t):
    return quality.reconcile_by(t.lines(customer=True), t.raw_lines().where(F.col("unit_price") > 0))


@query(
    "E18_check_expected",
    """
    WITH e AS (SELECT 'lines' AS metric, CAST(COUNT(*) AS DOUBLE) AS expected FROM lineitem UNION ALL SELECT 'units', SUM(l_quantity) FROM lineitem
               UNION ALL SELECT 'returns', COUNT(*) FILTER (l_returnflag = '?') FROM lineitem),
    a AS (SELECT 'lines' AS metric, CAST(COUNT(*) AS DOUBLE) AS actual FROM lineitem WHERE l_discount > 0 UNION ALL SELECT 'units', SUM(l_quantity) FROM lineitem
          UNION ALL SELECT 'returns', COUNT(*) FILTER (l_returnflag = '?') FROM lineitem),
    p AS (SELECT metric, expected, actual, CASE WHEN expected = 0 THEN CASE WHEN actual = 0 THEN 100.0 ELSE 0.0 END ELSE round(actual * 100 / expected, 2) END AS pct
          FROM e LEFT JOIN a USING (metric))
    SELECT *, CASE WHEN pct >= 99.9 THEN 'ok' WHEN pct >= 99 THEN 'warning' ELSE 'failed' END AS status FROM p""",
    "expected actual pct",
)
def _(t):
    names = ["lines", "units", "returns"]

    def long(condition):
        one = t.table("lineitem").agg(
            F.count_if(condition).cast("double").alias("lines"),
            F.sum("l_quantity").alias("units"),
            F.count_if(F.col("l_returnflag") == "?").cast("double").alias("returns"),
        )
        return one.unpivot([], names, "metric", "value")

    return quality.check_expected(long(F.col("l_discount") > 0), long(F.lit(True)))


@query(
    "E19_stack_stages",
    """
    WITH s AS (SELECT 'raw' AS stage, COUNT(*) AS line_items, SUM(line_total) AS revenue FROM x_raw
               UNION ALL SELECT 'enriched', COUNT(*), SUM(line_total) FROM x_priced)
    SELECT stage, 'line_items' AS metric, CAST(line_items AS DOUBLE) AS value FROM s UNION ALL SELECT stage, 'revenue', revenue FROM s""",
    "value",
)
def _(t):
    def totals(df):
        return df.agg(F.count("*").alias("line_items"), F.sum("line_total").alias("revenue"))

    return quality.stack_stages([("raw", totals(t.raw_lines())), ("enriched", totals(priced(t)))])


for k in (1.5, 2.0):

    @query(
        f"E20_outliers_iqr_{str(k).replace('.', '_')}",
        f"""
        WITH b AS (SELECT sku, COUNT(*) AS n, quantile_cont(weekly_quantity, 0.25) AS q1, quantile_cont(weekly_quantity, 0.75) AS q3 FROM x_sku GROUP BY sku)
        SELECT sku, year_week, weekly_quantity,
               CAST(n >= 5 AND (weekly_quantity < q1 - {k} * (q3 - q1) OR weekly_quantity > q3 + {k} * (q3 - q1)) AS INTEGER) AS is_outlier
        FROM x_sku JOIN b USING (sku)""",
        "weekly_quantity",
    )
    def _(t, k=k):
        weekly = t.sku_week().select("sku", "year_week", "weekly_quantity")
        return quality.outliers_iqr(weekly, ["sku"], "weekly_quantity", k)


@query(
    "E21_outliers_z",
    """
    SELECT sku, year_week, weekly_quantity,
           CAST(COALESCE(COUNT(*) OVER w >= 5 AND abs(weekly_quantity - avg(weekly_quantity) OVER w) / NULLIF(stddev_samp(weekly_quantity) OVER w, 0) > 2.5, false) AS INTEGER) AS is_outlier
    FROM x_sku WINDOW w AS (PARTITION BY sku)""",
    "weekly_quantity",
)
def _(t):
    weekly = t.sku_week().select("sku", "year_week", "weekly_quantity")
    return quality.outliers_z(weekly, ["sku"], "weekly_quantity", 2.5)


@query(
    "E22_winsorise",
    """
    WITH b AS (SELECT sku, quantile_cont(weekly_quantity, 0.05) AS lo, quantile_cont(weekly_quantity, 0.95) AS hi FROM x_sku GROUP BY sku)
    SELECT sku, year_week, weekly_quantity, LEAST(GREATEST(weekly_quantity, lo), hi) AS weekly_quantity_winsorised FROM x_sku JOIN b USING (sku)""",
    "weekly_quantity weekly_quantity_winsorised",
)
def _(t):
    weekly = t.sku_week().select("sku", "year_week", "weekly_quantity")
    return quality.winsorise(weekly, ["sku"], "weekly_quantity")


@query(
    "E23_missing_weeks",
    """
    WITH a AS (SELECT strftime(d, '%G-W%V') AS year_week FROM (SELECT unnest(generate_series(
                 date_trunc('week', MIN(l_shipdate)), date_trunc('week', MAX(l_shipdate)), INTERVAL 7 DAY)) AS d FROM lineitem)),
    s AS (SELECT DISTINCT strftime(o_orderdate, '%G-W%V') AS year_week FROM orders)
    SELECT a.year_week, CASE WHEN s.year_week IS NULL THEN 'MISSING' ELSE 'HAS_DATA' END AS status FROM a LEFT JOIN s USING (year_week)""",
)
def _(t):
    shipped = t.table("lineitem").select(cal.year_week("l_shipdate").alias("year_week"))
    ordered = t.table("orders").select(cal.year_week("o_orderdate").alias("year_week"))
    return quality.missing_weeks(ordered, cal.calendar_of(shipped))


