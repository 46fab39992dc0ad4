"""Projection, predicate and scalar queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import clean
from ..operators import models, windows
from .registry import PARTS, Sales, query

PARTS["x_text"] = """
    SELECT l_orderkey, l_linenumber,
           CASE l_linenumber WHEN 1 THEN concat(l_partkey, '.0') WHEN 2 THEN concat(' ', l_partkey, ' ')
                WHEN 3 THEN concat('X-', l_partkey) WHEN 4 THEN '' ELSE CAST(l_partkey AS VARCHAR) END AS sku,
           CASE WHEN l_linenumber = 5 THEN concat('-', CAST(CAST(l_quantity AS INTEGER) AS VARCHAR))
                ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
           CASE l_linenumber WHEN 6 THEN '0' WHEN 7 THEN 'n/a'
                ELSE CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) AS VARCHAR) END AS price,
           CASE WHEN l_returnflag <> 'A'
                THEN CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) AS VARCHAR) END AS total
    FROM lineitem"""

PARTS["x_weeks"] = """
    SELECT DISTINCT strftime(o_orderdate, '%G-W%V') AS year_week,
           CAST(strftime(o_orderdate, '%V') AS INTEGER) AS week_num FROM orders"""


def text_lines(t: Sales):
    """Line items as an export shows them: every field text, codes and numbers in mixed shapes."""
    line, part = F.col("l_linenumber"), F.col("l_partkey").cast("string")
    units = F.col("l_quantity").cast("int").cast("string")
    amount = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    return t.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(line == 1, F.concat(part, F.lit(".0")))
        .when(line == 2, F.concat(F.lit(" "), part, F.lit(" ")))
        .when(line == 3, F.concat(F.lit("X-"), part))
        .when(line == 4, "")
        .otherwise(part)
        .alias("sku"),
        F.when(line == 5, F.concat(F.lit("-"), units)).otherwise(units).alias("quantity"),
        F.when(line == 6, "0").when(line == 7, "n/a").otherwise(amount).alias("price"),
        F.when(F.col("l_returnflag") != "A", amount).alias("total"),
    )


def weeks(t: Sales):
    """The distinct weeks of the orders."""
    keyed = t.table("orders").select(cal.year_week("o_orderdate").alias("year_week")).distinct()
    return keyed.withColumn("week_num", cal.week_num("year_week"))


@query(
    "P01_normalise_lines",
    """
    WITH typed AS (
      SELECT l_orderkey, l_linenumber,
             CAST(CAST(trunc(TRY_CAST(trim(sku) AS DOUBLE)) AS BIGINT) AS VARCHAR) AS sku,
             TRY_CAST(quantity AS DOUBLE) AS quantity, COALESCE(TRY_CAST(price AS DOUBLE), 0) AS p,
             TRY_CAST(total AS DOUBLE) AS t0
      FROM x_text)
    SELECT l_orderkey, l_linenumber, sku, quantity,
           CASE WHEN p = 0 AND COALESCE(t0, quantity * p) > 0 THEN COALESCE(t0, quantity * p) / quantity ELSE p END AS unit_price,
           COALESCE(t0, quantity * p) AS line_total
    FROM typed WHERE sku IS NOT NULL AND quantity > 0""",
    "quantity unit_price line_total",
)
def _(t):
    return clean.normalise_lines(text_lines(t))


@query(
    "P02_sku_code",
    """
    SELECT sku,
           CAST(CAST(trunc(TRY_CAST(trim(sku) AS DOUBLE)) AS BIGINT) AS VARCHAR) AS strict_code,
           COALESCE(CAST(CAST(trunc(TRY_CAST(trim(sku) AS DOUBLE)) AS BIGINT) AS VARCHAR), trim(sku)) AS lenient_code,
           COUNT(*) AS n
    FROM x_text GROUP BY ALL""",
)
def _(t):
    codes = text_lines(t).select(
        "sku", clean.sku_code("sku").alias("strict_code"), clean.sku_code("sku", False).alias("lenient_code")
    )
    return codes.groupBy("sku", "strict_code", "lenient_code").agg(F.count("*").alias("n"))


@query(
    "P03_sku_clean",
    """
    SELECT p_partkey, regexp_replace(code, '[^a-zA-Z0-9]', '', 'g') AS sku
    FROM (SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'NaN' WHEN 'SMALL' THEN ' - '
                 ELSE concat(p_brand, '-', p_partkey) END AS code FROM part)
    WHERE regexp_replace(code, '[^a-zA-Z0-9]', '', 'g') <> ''
      AND lower(regexp_replace(code, '[^a-zA-Z0-9]', '', 'g')) NOT IN ('nan', 'none', 'null')""",
)
def _(t):
    code = (
        F.when(F.col("p_type") == "PROMO", "NaN")
        .when(F.col("p_type") == "SMALL", " - ")
        .otherwise(F.concat_ws("-", "p_brand", "p_partkey"))
    )
    return clean.sku_clean(t.table("part").select("p_partkey", code.alias("sku")), "sku")


@query(
    "P04_prefix",
    "SELECT p_partkey, concat('SKU-', p_partkey) AS prefixed, CAST(p_partkey AS VARCHAR) AS stripped FROM part",
)
def _(t):
    df = t.table("part").select("p_partkey", clean.add_prefix("p_partkey", "SKU-").alias("prefixed"))
    return df.withColumn("stripped", clean.strip_prefix("prefixed", "SKU-"))


@query(
    "P05_to_number",
    """
    SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS rank_no,
           TRY_CAST(o_orderpriority AS DOUBLE) AS invalid_no,
           COALESCE(TRY_CAST(o_orderpriority AS DOUBLE), 0) AS invalid_as_zero FROM orders""",
    "rank_no invalid_no invalid_as_zero",
)
def _(t):
    return t.table("orders").select(
        "o_orderkey",
        clean.to_number(F.substring("o_orderpriority", 1, 1)).alias("rank_no"),
        clean.to_number("o_orderpriority").alias("invalid_no"),
        clean.to_number("o_orderpriority", 0).alias("invalid_as_zero"),
    )


@query(
    "P06_to_date",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderdate AS DATE)
                       ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS order_date
    FROM orders""",
)
def _(t):
    day = F.col("o_orderdate").cast("date")
    text = F.when(F.col("o_orderstatus") == "O", day.cast("string")).when(F.col("o_orderstatus") == "F", "n/a")
    return t.table("orders").select("o_orderkey", clean.to_date(text, F.trunc(day, "month")).alias("order_date"))


@query(
    "P07_year_week",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%G-W%V') AS iso_week,
           strftime(o_orderdate, '%Y-W%V') AS calendar_year_week FROM orders""",
)
def _(t):
    return t.table("orders").select(
        "o_orderkey",
        cal.year_week("o_orderdate").alias("iso_week"),
        cal.year_week("o_orderdate", iso_year=False).alias("calendar_year_week"),
    )


@query("P08_week_num", "SELECT year_week, week_num FROM x_weeks")
def _(t):
    return weeks(t)


@query(
    "P09_week_start",
    "SELECT DISTINCT strftime(o_orderdate, '%G-W%V') AS year_week, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start FROM orders",
)
def _(t):
    return weeks(t).select("year_week", cal.week_start("year_week").alias("week_start"))


@query("P10_date_to_week", "SELECT DISTINCT year_week, year_week AS round_trip FROM x_weeks")
def _(t):
    return weeks(t).select("year_week", cal.year_week(cal.week_start("year_week")).alias("round_trip"))


@query(
    "P11_temporal_features",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
           CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           CAST(week(o_orderdate) AS INTEGER) AS week_of_year, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS day_of_week,
           CAST(day(o_orderdate) AS INTEGER) AS day_of_month, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
           CAST(isodow(o_orderdate) >= 6 AS INTEGER) AS is_weekend, CAST(day(o_orderdate) <= 7 AS INTEGER) AS is_month_start,
           CAST(day(o_orderdate) >= 25 AS INTEGER) AS is_month_end, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start
    FROM orders""",
)
def _(t):
    orders = t.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    return cal.temporal_features(orders, "order_date")


@query(
    "P12_week_month_quarter",
    """
    SELECT year_week, LEAST((week_num - 1) // 4 + 1, 12) AS month,
           (LEAST((week_num - 1) // 4 + 1, 12) - 1) // 3 + 1 AS quarter,
           (week_num - 1) // 13 + 1 AS quarter_nb FROM x_weeks""",
)
def _(t):
    return weeks(t).select(
        "year_week",
        cal.week_month("week_num").alias("month"),
        cal.week_quarter("week_num").alias("quarter"),
        cal.week_quarter("week_num", "nb").alias("quarter_nb"),
    )


# The week lists of the calendar flags.
FLAG_SQL = {
    "sql": """CAST(week_num BETWEEN 47 AND 52 AS INTEGER) AS is_holiday_season, (week_num - 1) % 4 + 1 AS week_of_month,
        CAST(week_num IN (4, 8, 13, 17, 22, 26, 30, 35, 39, 43, 48, 52) AS INTEGER) AS is_month_end,
        CAST(week_num IN (13, 26, 39, 52) AS INTEGER) AS is_quarter_end""",
    "v3": """CAST(week_num >= 47 AS INTEGER) AS is_holiday_season, CAST(week_num % 4 = 1 AS INTEGER) AS is_month_start,
        CAST(week_num % 4 = 0 AS INTEGER) AS is_month_end""",
    "v3_2": "CAST(week_num >= 45 AS INTEGER) AS is_holiday_season",
    "v4": "CAST(week_num >= 45 OR week_num <= 2 AS INTEGER) AS is_holiday_season",
    "nb": """CAST(week_num IN (1, 5, 9, 14, 18, 22, 27, 31, 36, 40, 44, 48) AS INTEGER) AS is_month_start,
        CAST(week_num IN (4, 8, 13, 17, 21, 26, 30, 35, 39, 43, 47, 52) AS INTEGER) AS is_month_end""",
}

for variant, columns in FLAG_SQL.items():

    @query(
        f"P13_calendar_flags_{variant}",
        f"SELECT year_week, week_num, CAST(week_num = 47 AS INTEGER) AS is_w47, {columns} FROM x_weeks",
    )
    def _(t, variant=variant):
        return cal.calendar_flags(weeks(t), "week_num", variant)


@query(
    "P14_cyclical",
    """
    SELECT year_week, week_num, sin(2 * pi() * week_num / 52) AS week_sin, cos(2 * pi() * week_num / 52) AS week_cos
    FROM x_weeks""",
    "week_sin week_cos",
)
def _(t):
    return cal.cyclical(weeks(t))


@query(
    "P15_period",
    """
    SELECT year_week, CASE WHEN week_num <= 26 THEN 'H1' ELSE 'H2' END AS period_by_number,
           CASE WHEN year_week <= '1998-W26' THEN 'H1' ELSE 'H2' END AS period_by_text FROM x_weeks""",
)
def _(t):
    return weeks(t).select(
        "year_week",
        cal.period("year_week").alias("period_by_number"),
        cal.period("year_week", "1998-W26").alias("period_by_text"),
    )


@query(
    "P16_category_levels",
    """
    SELECT p_partkey, CASE WHEN p_size <= 10 THEN 'Unknown' ELSE p_type END AS category_l1,
           CASE WHEN p_size <= 10 THEN 'Unknown' WHEN p_size <= 20 THEN p_type ELSE p_brand END AS category_l2,
           CASE WHEN p_size <= 10 THEN 'Unknown' WHEN p_size <= 20 THEN p_type ELSE p_name END AS category_l3,
           CASE WHEN p_size <= 10 THEN 'Unknown' WHEN p_size <= 20 THEN p_type ELSE p_name END AS leaf FROM part""",
)
def _(t):
    path = (
        F.when(F.col("p_size") <= 10, "")
        .when(F.col("p_size") <= 20, F.concat_ws("/", F.lit("Root"), "p_type"))
        .otherwise(F.concat_ws("/", F.lit("Root"), "p_type", "p_brand", "p_name"))
    )
    l1, l2, l3 = clean.category_levels(path)
    return t.table("part").select(
        "p_partkey",
        l1.alias("category_l1"),
        l2.alias("category_l2"),
        l3.alias("category_l3"),
        clean.leaf_category(path).alias("leaf"),
    )


@query("P17_leaf_category", "SELECT p_partkey, p_name AS leaf FROM part")
def _(t):
    return t.products().select(F.col("sku").alias("p_partkey"), clean.leaf_category("category_path").alias("leaf"))


@query(
    "P18_map_code",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE o_orderpriority END AS label
    FROM orders""",
)
def _(t):
    label = clean.map_code("o_orderstatus", {"F": "Finished", "O": "Open"}, F.col("o_orderpriority"))
    return t.table("orders").select("o_orderkey", label.alias("label"))


@query(
    "P19_ordinal",
    """
    SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3 ELSE 0 END AS segment_code
    FROM customer""",
)
def _(t):
    code = clean.ordinal("c_mktsegment", {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3})
    return t.table("customer").select("c_custkey", code.alias("segment_code"))


@query(
    "P20_safe_div",
    "SELECT l_orderkey, l_linenumber, l_extendedprice / NULLIF(l_discount, 0) AS ratio FROM lineitem",
    "ratio",
)
def _(t):
    return t.table("lineitem").select(
        "l_orderkey", "l_linenumber", clean.safe_div("l_extendedprice", "l_discount").alias("ratio")
    )


@query(
    "P21_clip",
    """
    SELECT c_custkey, GREATEST(c_acctbal, 0) AS floored, LEAST(c_acctbal / 100, 20) AS capped,
           LEAST(GREATEST(c_acctbal, -100), 100) AS boxed FROM customer""",
    "floored capped boxed",
)
def _(t):
    return t.table("customer").select(
        "c_custkey",
        clean.clip("c_acctbal", lo=0.0).alias("floored"),
        clean.clip(F.col("c_acctbal") / 100, hi=20.0).alias("capped"),
        clean.clip("c_acctbal", -100.0, 100.0).alias("boxed"),
    )


@query(
    "P22_clean_nulls",
    """
    SELECT p_partkey, CASE WHEN p_type IN ('PROMO', 'SMALL') THEN NULL ELSE p_type END AS kind,
           CASE WHEN p_size <= 3 THEN NULL ELSE p_retailprice END AS price FROM part""",
    "price",
)
def _(t):
    size = F.col("p_size")
    price = (
        F.when(size == 1, float("inf")).when(size == 2, float("-inf")).when(size == 3, float("nan"))
        .otherwise(F.col("p_retailprice"))
    )
    kind = F.when(F.col("p_type") == "PROMO", "NaN").when(F.col("p_type") == "SMALL", "None").otherwise(F.col("p_type"))
    return clean.clean_nulls(t.table("part").select("p_partkey", kind.alias("kind"), price.alias("price")))


@query(
    "P23_list_literal",
    """
    SELECT entry, COUNT(*) AS n FROM (
      SELECT CAST(l_partkey AS VARCHAR) AS entry FROM lineitem UNION ALL SELECT CAST(l_suppkey AS VARCHAR) FROM lineitem)
    GROUP BY entry""",
)
def _(t):
    literal = F.concat(F.lit("['"), "l_partkey", F.lit("', '"), "l_suppkey", F.lit("']"))
    rows = t.table("lineitem").select(F.explode(clean.list_literal(literal)).alias("entry"))
    return rows.groupBy("entry").agg(F.count("*").alias("n"))


@query(
    "P23_list_text",
    "SELECT l_orderkey, l_linenumber, concat(l_partkey, ', ', l_suppkey) AS ids FROM lineitem",
)
def _(t):
    literal = F.concat(F.lit("['"), "l_partkey", F.lit("', '"), "l_suppkey", F.lit("']"))
    return t.table("lineitem").select("l_orderkey", "l_linenumber", clean.list_text(literal).alias("ids"))


@query("P24_standard_names", "SELECT p_partkey AS part_key, p_brand AS brandname, p_size AS part_size FROM part")
def _(t):
    return clean.standard_names(
        t.table("part").select(
            F.col("p_partkey").alias("Part Key"), F.col("p_brand").alias("Brand.Name"), F.col("p_size").alias(" Part Size ")
        )
    )


@query(
    "P25_integral_ids",
    """
    SELECT p_partkey, CASE WHEN p_retailprice % 1 = 0 THEN CAST(p_retailprice AS BIGINT) END AS price_id FROM part""",
)
def _(t):
    df = t.table("part").select("p_partkey", F.col("p_retailprice").alias("price_id"))
    return clean.integral_ids(df, ["price_id"])


@query(
    "P26_feature_defaults",
    """
    SELECT brand, year_week, weekly_quantity,
           COALESCE(LAG(weekly_quantity) OVER w, 0) AS lag1,
           COALESCE(AVG(weekly_quantity) OVER (PARTITION BY brand ORDER BY year_week ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), weekly_quantity) AS rolling_avg_4w,
           COALESCE(LAG(avg_unit_price) OVER w, avg_unit_price) AS prev_price
    FROM x_brand WINDOW w AS (PARTITION BY brand ORDER BY year_week)""",
    "weekly_quantity lag1 rolling_avg_4w prev_price",
)
def _(t):
    df = windows.lags(t.brand_week(), ["brand"], "year_week", "weekly_quantity", (1,))
    df = windows.rolling_mean(df, ["brand"], "year_week", "weekly_quantity")
    df = windows.price_features(df, ["brand"], "year_week")
    df = clean.feature_defaults(
        df, {"lag1": 0.0, "rolling_avg_4w": F.col("weekly_quantity"), "prev_price": F.col("avg_unit_price")}
    )
    return df.select("brand", "year_week", "weekly_quantity", "lag1", "rolling_avg_4w", "prev_price")


@query(
    "P27_presence",
    """
    SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'NULL' WHEN c_acctbal < 0 THEN 'EMPTY' ELSE 'HAS_ID' END AS status,
           COUNT(*) AS n FROM customer GROUP BY 1""",
)
def _(t):
    ident = F.when(F.col("c_mktsegment") != "BUILDING", F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_custkey").cast("string")))
    return t.table("customer").groupBy(clean.presence(ident).alias("status")).agg(F.count("*").alias("n"))


@query(
    "P28_split_week",
    "SELECT year_week, substr(year_week, 1, 4) AS year, substr(year_week, 7, 2) AS week FROM x_weeks",
)
def _(t):
    year, week = cal.split_week("year_week")
    return weeks(t).select("year_week", year.alias("year"), week.alias("week"))


@query(
    "P29_fmt_number",
    "SELECT brand, concat('R', format('{:,}', CAST(SUM(quantity) * 1000 AS BIGINT))) AS units FROM x_lines GROUP BY brand",
)
def _(t):
    sums = t.lines(product=True).groupBy("brand").agg(F.sum("quantity").alias("q"))
    return sums.select("brand", clean.fmt_number(F.col("q") * 1000, "R").alias("units"))


@query(
    "P30_encode_sku",
    """
    WITH codes AS (SELECT sku, row_number() OVER (ORDER BY sku) - 1 AS code
                   FROM (SELECT DISTINCT sku FROM x_lines WHERE year_week <= '1995-W12'))
    SELECT p_partkey AS sku, COALESCE(code, -1) AS sku_encoded FROM part LEFT JOIN codes ON p_partkey = sku""",
)
def _(t):
    early = t.lines().where(F.col("year_week") <= "1995-W12")
    return models.encode(t.products().select("sku"), early, "sku")


@query(
    "P30_encode_brand",
    """
    SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS BIGINT) AS p_brand_encoded FROM part""",
)
def _(t):
    parts = t.table("part").select("p_partkey", "p_brand")
    return models.encode(parts, parts, "p_brand").drop("p_brand")


@query(
    "P31_filters",
    """
    SELECT sku, year_week, weekly_quantity FROM x_sku
    WHERE weekly_quantity > 10 AND avg_unit_price > 0 AND (week_num = 47 OR week_num <= 2)""",
    "weekly_quantity",
)
def _(t):
    w = cal.week_num("year_week")
    df = t.sku_week().where((F.col("weekly_quantity") > 10) & (F.col("avg_unit_price") > 0) & ((w == 47) | (w <= 2)))
    return df.select("sku", "year_week", "weekly_quantity")


@query("P31_account_sales", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'", "o_totalprice")
def _(t):
    return t.table("orders").where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


@query(
    "P32_complete_rows",
    """
    SELECT * FROM (SELECT sku, year_week, LAG(weekly_quantity, 1) OVER w AS lag1, LAG(weekly_quantity, 4) OVER w AS lag4
                   FROM x_sku WINDOW w AS (PARTITION BY sku ORDER BY year_week))
    WHERE lag1 IS NOT NULL AND lag4 IS NOT NULL""",
    "lag1 lag4",
)
def _(t):
    df = windows.lags(t.sku_week(), ["sku"], "year_week", "weekly_quantity", (1, 4))
    return clean.complete_rows(df.select("sku", "year_week", "lag1", "lag4"), ["lag1", "lag4"])


@query(
    "P33_days_between",
    """
    SELECT o_custkey, CAST(DATE '2001-12-31' - MAX(CAST(o_orderdate AS DATE)) AS INTEGER) AS days_since FROM orders GROUP BY o_custkey""",
)
def _(t):
    last = t.table("orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("d"))
    return last.select("o_custkey", cal.days_between(F.lit("2001-12-31"), "d").alias("days_since"))


@query(
    "P34_week_calendar",
    "SELECT week_start, year_week FROM x_calendar",
)
def _(t):
    return cal.calendar_of(weeks(t))


@query(
    "P35_holiday_flags",
    """
    WITH years AS (SELECT DISTINCT CAST(substr(year_week, 1, 4) AS INTEGER) AS y FROM x_weeks),
    s1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
    s2 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM s1),
    s3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM s2),
    s4 AS (SELECT *, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS m FROM s3),
    easter AS (SELECT y, make_date(y, m // 31, m % 31 + 1) AS d FROM s4)
    SELECT year_week, CAST(strftime(d, '%G-W%V') = year_week AS INTEGER) AS is_easter_week,
           CAST(week_num <= 2 AS INTEGER) AS is_new_year_slowdown, CAST(week_num >= 48 AS INTEGER) AS is_late_year,
           CAST(week_num = 52 AS INTEGER) AS is_holiday_week
    FROM x_weeks JOIN easter ON y = CAST(substr(year_week, 1, 4) AS INTEGER)""",
)
def _(t):
    holidays = weeks(t).where(F.col("week_num") == 52).select(cal.week_start("year_week").alias("week_start"))
    return cal.holiday_flags(weeks(t).select("year_week"), "year_week", holidays)
