"""Counters, profiles, fingerprints, reconciliation, outliers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import flag
from ..functions.clean import NULL_WORDS, exceeds, safe_div
from ..functions.distributed import exact_percentiles

# Columns whose distinct values a fingerprint counts.
DISTINCT_COLUMNS = {
    "sku": "unique_skus",
    "invoice_id": "unique_invoices",
    "customer_id": "unique_customers",
    "category": "unique_categories",
    "region_name": "unique_regions",
    "year_week": "unique_weeks",
}


def quality_counters(df: DataFrame) -> DataFrame:
    """Null, zero, negative and blank counts in one pass."""
    return df.agg(
        F.count_if(F.col("sku").isNull()).alias("null_skus"),
        F.count_if(F.col("quantity").isNull()).alias("null_quantities"),
        F.count_if(F.col("quantity") == 0).alias("zero_quantities"),
        F.count_if(F.col("quantity") < 0).alias("negative_quantities"),
        F.count_if(F.col("unit_price").isNull()).alias("null_prices"),
        F.count_if(F.col("unit_price") == 0).alias("zero_prices"),
        F.count_if(F.col("region_name") == "Unknown").alias("unknown_region_count"),
        F.count_if(F.col("customer_id").isNull() | (F.col("customer_id") == "")).alias("empty_customer_ids"),
    )


def profile_columns(df: DataFrame) -> DataFrame:
    """Format checks of every column over the whole table, one row per column."""
    checks = []
    for field in df.schema.fields:
        c, text = F.col(field.name), F.col(field.name).cast("string")
        is_text = isinstance(field.dataType, T.StringType)
        is_real = isinstance(field.dataType, (T.DoubleType, T.FloatType))
        is_id = "_id" in field.name.lower() or field.name.lower() == "sku"
        is_week = field.name.lower() == "year_week" or field.name.lower().endswith("_week")
        none = F.lit(0).cast("bigint")
        checks.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.count_if(c.isNull()).alias("null_count"),
                (F.count_if(text.rlike(r"^\[.*\]$")) if is_text else none).alias("list_syntax_count"),
                (F.count_if(F.abs(c) == float("inf")) if is_real else none).alias("inf_count"),
                (F.count_if(F.lower(c).isin(*NULL_WORDS)) if is_text else none).alias("null_word_count"),
                (F.count_if(text.rlike(r"^\d+\.?\d*$")) if is_id else none).alias("numeric_id_count"),
                (F.count_if(text.rlike(r"^[A-Za-z_]")) if is_id else none).alias("alpha_id_count"),
                (F.count_if(~text.rlike(r"^\d{4}-W\d{2}$")) if is_week else none).alias("bad_week_count"),
                F.lit(int(" " in field.name)).alias("bad_name"),
            )
        )
    return df.agg(F.array(*checks).alias("_c")).select(F.inline("_c"))


def fingerprint(df: DataFrame, name: str, approx: bool = False) -> DataFrame:
    """Row, column and distinct counts, spans and totals of a table.

    `approx` swaps the exact distinct counts for mergeable sketches.
    """
    distinct = F.approx_count_distinct if approx else F.count_distinct
    parts = [F.count("*").alias("row_count"), F.lit(len(df.columns)).cast("bigint").alias("column_count")]
    parts += [distinct(F.col(c)).alias(a) for c, a in DISTINCT_COLUMNS.items() if c in df.columns]
    if "year_week" in df.columns:
        parts += [F.min("year_week").alias("first_week"), F.max("year_week").alias("last_week")]
    if "order_date" in df.columns:
        parts += [F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date")]
    for c, a in (("quantity", "total_quantity"), ("line_total", "total_revenue")):
        if c in df.columns:
            parts.append(F.sum(c).alias(a))
    return df.agg(*parts).select(F.lit(name).alias("table_name"), "*")


def content_hash(df: DataFrame) -> DataFrame:
    """A hash of the rows that does not depend on their order; repeated rows count."""
    row = F.xxhash64(*df.columns)
    return df.agg(
        F.bit_xor(row).alias("hash_xor"), F.sum(row.cast("decimal(38,0)")).alias("hash_sum")
    )


PRIME = 2**61 - 1
PARTS = 4  # of 15 hexadecimal digits of a row's digest each


def canonical_text(df: DataFrame, column: str) -> Column:
    """A value as text that any engine can state: whole numbers, six decimals, microseconds; with its length before it."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.FractionalType):
        value = value.cast("decimal(28,6)").cast("string")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = F.unix_micros(value.cast("timestamp")).cast("string")
    else:
        value = value.cast("string")
    return F.coalesce(F.concat(F.char_length(value), F.lit(":"), value), F.lit("-"))


def multiset_hash(df: DataFrame, by: list[str] = (), columns: list[str] | None = None) -> DataFrame:
    """(by, n_rows, h0 to h3): parts of each row's digest, summed modulo a prime.

    Rows count as often as they occur and in any order. Hashes of parts of a table add up to that of the whole, so a
    file can be added or taken away with `combined` and no other file is read again. Column order and names don't enter;
    the listed columns (default: all others) do, in this order.
    """
    columns = columns or [c for c in df.columns if c not in by]
    digest = F.sha2(F.concat(*[canonical_text(df, c) for c in columns]), 256)
    part = lambda k: F.conv(F.substring(digest, 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)")
    total = lambda k: (F.sum(part(k)) % F.lit(PRIME).cast("decimal(20,0)")).cast("bigint")
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), *[F.coalesce(total(k), F.lit(0).cast("bigint")).alias(f"h{k}") for k in range(PARTS)])


def combined(added: DataFrame, removed: DataFrame | None = None, by: list[str] = ()) -> DataFrame:
    """The multiset hash of all rows behind `added` without those behind `removed`, from the hashes alone."""
    rows = added.withColumn("_sign", F.lit(1))
    if removed is not None:
        rows = rows.unionByName(removed.withColumn("_sign", F.lit(-1)))
    wide = lambda c: F.sum(F.col("_sign") * F.col(c).cast("decimal(20,0)"))
    held = lambda c: F.coalesce(F.pmod(wide(c), F.lit(PRIME).cast("decimal(38,0)")).cast("bigint"), F.lit(0).cast("bigint")).alias(c)
    n = F.coalesce(F.sum(F.col("_sign") * F.col("n_rows")), F.lit(0)).cast("bigint").alias("n_rows")
    return rows.groupBy(*by).agg(n, *[held(f"h{k}") for k in range(PARTS)])


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, nulls, mean, std, min, quartiles and max per numeric column."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column_name", "_v")
    moments = long.groupBy("column_name").agg(
        F.count("_v").alias("value_count"),
        F.count_if(F.col("_v").isNull()).alias("null_count"),
        F.avg("_v").alias("mean"),
        F.stddev_samp("_v").alias("std"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
    )
    quartiles = exact_percentiles(long, ["column_name"], "_v", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return moments.join(quartiles, "column_name", "left")


def stage_totals(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count("*").alias("line_items"),
        F.count_distinct("invoice_id").alias("invoices"),
        F.sum("quantity").alias("quantity"),
        F.sum("line_total").alias("revenue"),
    )


def capture_pct(raw: str, extracted: str) -> F.Column:
    """Extracted over raw in percent; nothing raw counts as 100 when something was extracted."""
    ratio = F.round(safe_div(F.col(extracted) * 100, raw), 2)
    return F.when(F.col(raw) > 0, ratio).when(F.col(extracted) > 0, 100.0).otherwise(0.0)


def capture_status(pct: F.Column) -> F.Column:
    return F.when(pct >= 99, "ok").when(pct >= 95, "warning").when(pct == 0, "new").otherwise("failed")


def reconcile(raw: DataFrame, extracted: DataFrame) -> DataFrame:
    """Line, invoice, quantity and revenue totals of two stages."""
    metrics = ["line_items", "invoices", "quantity", "revenue"]

    def long(df: DataFrame, name: str) -> DataFrame:
        totals = stage_totals(df, []).select(*[F.col(m).cast("double").alias(m) for m in metrics])
        return totals.unpivot([], metrics, "metric", name)

    joined = long(raw, "raw_value").join(long(extracted, "extracted_value"), "metric")
    pct = F.when(F.col("raw_value") > 0, F.round(F.col("extracted_value") / F.col("raw_value") * 100, 2)).otherwise(0.0)
    return joined.withColumns({"diff": F.col("extracted_value") - F.col("raw_value"), "pct": pct}).withColumn(
        "status", capture_status(F.col("pct"))
    )


def reconcile_by(raw: DataFrame, extracted: DataFrame, by: str = "region_name") -> DataFrame:
    """Quantity per key, full outer, so a key missing on one side still shows."""
    left = raw.groupBy(by).agg(F.sum("quantity").alias("raw_qty"))
    right = extracted.groupBy(by).agg(F.sum("quantity").alias("extracted_qty"))
    joined = left.join(right, by, "full_outer").fillna(0, ["raw_qty", "extracted_qty"])
    return joined.withColumns(
        {
            "diff": F.col("extracted_qty") - F.col("raw_qty"),
            "pct": capture_pct("raw_qty", "extracted_qty"),
        }
    ).withColumn("status", capture_status(F.col("pct")))


def check_expected(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """(metric, value) tables side by side."""
    joined = expected.withColumnRenamed("value", "expected").join(
        actual.withColumnRenamed("value", "actual"), "metric", "left"
    )
    pct = F.when(
        F.col("expected") == 0, F.when(F.col("actual") == 0, 100.0).otherwise(0.0)
    ).otherwise(F.round(safe_div(F.col("actual") * 100, "expected"), 2))
    return joined.withColumn("pct", pct).withColumn(
        "status", F.when(F.col("pct") >= 99.9, "ok").when(F.col("pct") >= 99, "warning").otherwise("failed")
    )


def stack_stages(stages: list[tuple[str, DataFrame]]) -> DataFrame:
    """(stage, metric, value) of one-row summaries."""
    parts = []
    for name, df in stages:
        row = df.select(*[F.col(c).cast("double").alias(c) for c in df.columns])
        long = row.unpivot([], row.columns, "metric", "value")
        parts.append(long.select(F.lit(name).alias("stage"), "metric", "value"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def series(e: list[str]) -> Window:
    """All rows of one entity's weekly series, a group no longer than the calendar."""
    return Window.partitionBy(*e)


def outliers_iqr(df: DataFrame, e: list[str], y: str, k: float = 1.5, min_n: int = 5) -> DataFrame:
    """Outside Q1 - k IQR .. Q3 + k IQR of the entity's series of at least `min_n` rows."""
    w = series(e)
    quartile = F.percentile(y, F.array(F.lit(0.25), F.lit(0.75))).over(w)
    scored = df.withColumns({"_q": quartile, "_n": F.count("*").over(w)})
    reach = (F.col("_q")[1] - F.col("_q")[0]) * k
    outside = (F.col(y) < F.col("_q")[0] - reach) | (F.col(y) > F.col("_q")[1] + reach)
    return scored.withColumn("is_outlier", flag((F.col("_n") >= min_n) & outside)).drop("_q", "_n")


def outliers_z(
    df: DataFrame, e: list[str], y: str, k: float = 3.0, min_n: int = 5, name: str = "is_outlier"
) -> DataFrame:
    """More than k sample deviations off the mean of an entity of at least `min_n` rows."""
    w = series(e)
    scored = df.withColumns({"_m": F.avg(y).over(w), "_s": F.stddev_samp(y).over(w), "_n": F.count("*").over(w)})
    z = safe_div(F.abs(F.col(y) - F.col("_m")), "_s")
    outside = F.coalesce((F.col("_n") >= min_n) & exceeds(z, k), F.lit(False))
    return scored.withColumn(name, flag(outside)).drop("_m", "_s", "_n")


def winsorise(
    df: DataFrame, e: list[str], y: str, lo: float = 0.05, hi: float = 0.95, name: str | None = None
) -> DataFrame:
    """Clip to the entity's own quantiles."""
    bounds = F.percentile(y, F.array(F.lit(lo), F.lit(hi))).over(series(e))
    clipped = F.least(F.greatest(F.col(y), F.col("_b")[0]), F.col("_b")[1])
    return df.withColumn("_b", bounds).withColumn(name or f"{y}_winsorised", clipped).drop("_b")


def missing_weeks(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every calendar week and whether it has data."""
    seen = df.select("year_week").distinct().withColumn("_seen", F.lit(1))
    return calendar.join(seen, "year_week", "left").select(
        "year_week", F.when(F.col("_seen").isNull(), "MISSING").otherwise("HAS_DATA").alias("status")
    )
