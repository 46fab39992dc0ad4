"""Exported spreadsheet rows: file choice, sheet kinds, headers, invoice headers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import as_col
from ..functions.clean import to_date

# File-name fragments and their regions, first match wins.
REGION_PATTERNS = {
    "cape town": "Cape Town",
    "capetown": "Cape Town",
    "gauteng": "Gauteng",
    "capital gauteng": "Gauteng",
    "george": "George",
    "hardware": "Hardware",
    "polokwane": "Polokwane",
    "limpopo": "Polokwane",
}

# File names that hold no sales lines.
SKIPPED_FILES = ("dub_", "_dt_")

# Months that name a summary sheet, and words of sheets without invoices.
MONTHS = (
    "january",
    "february",
    "march",
    "april",
    "may",
    "june",
    "july",
    "august",
    "september",
    "october",
    "november",
    "december",
)
NON_INVOICE_WORDS = ("debtor", "master", "summary", "sheet")

# Header fragments per field, tested in this order.
HEADER_ALIASES = {
    "sku": ("stockcode", "stock_code", "sku"),
    "description": ("desc",),
    "quantity": ("quantity", "qty", "quant"),
    "price": ("price",),
    "total": ("total", "linetotal", "line_total", "totalincl"),
}


def contains_any(c: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def region_from_name(c: Column | str, patterns: dict[str, str] = REGION_PATTERNS) -> Column:
    """Region of a file name, else `Unknown`."""
    name = F.lower(as_col(c))
    return F.coalesce(*[F.when(name.contains(k), v) for k, v in patterns.items()], F.lit("Unknown"))


def select_sources(manifest: DataFrame) -> DataFrame:
    """One file per (month, region): corrected, else v2, else the first by name."""
    name = F.lower("file_name")
    rank = F.when(name.contains("corrected"), 0).when(name.contains("v2"), 1).otherwise(2)
    usable = ~(name.startswith("~$") | name.endswith(".xlsm") | contains_any(name, SKIPPED_FILES))
    best = manifest.where(usable).groupBy("month", "region").agg(
        F.min(F.struct(rank.alias("r"), F.col("file_name").alias("f"))).alias("b")
    )
    return best.select("month", "region", F.col("b.f").alias("file_name"))


def classify_sheet(c: Column | str) -> Column:
    """Invoice / summary / debtors / other, from the sheet name."""
    name = F.lower(as_col(c))
    bare = F.regexp_replace(name, r"[. ]", "")
    debtors = name.contains("debtor") & name.contains("master")
    short_month = contains_any(name, [m[:3] for m in MONTHS])
    summary = contains_any(name, ("summary", *MONTHS)) & ~contains_any(name, ("debtor", "master"))
    invoice = bare.rlike(r"^\d{5,}$") & ~contains_any(name, NON_INVOICE_WORDS) & ~short_month
    return F.when(debtors, "debtors").when(summary, "summary").when(invoice, "invoice").otherwise("other")


def header_field(c: Column) -> Column:
    """The field a free-form header stands for; a price header must not say total."""
    name = F.regexp_replace(F.lower(F.trim(c)), r"[ .]", "")
    return F.coalesce(
        F.when(contains_any(name, HEADER_ALIASES["sku"]), "sku"),
        F.when(contains_any(name, HEADER_ALIASES["description"]), "description"),
        F.when(contains_any(name, HEADER_ALIASES["quantity"]), "quantity"),
        F.when(contains_any(name, HEADER_ALIASES["price"]) & ~name.contains("total"), "price"),
        F.when(contains_any(name, HEADER_ALIASES["total"]), "total"),
    )


def resolve_headers(df: DataFrame, cells: str = "cells") -> DataFrame:
    """A map of ragged cells to the five fields; the last header in key order wins."""
    fields = F.transform(
        F.array_sort(F.map_entries(cells)),
        lambda e: F.struct(header_field(e["key"]).alias("field"), e["value"].alias("value")),
    )
    rows = df.withColumn("_f", fields)

    def value_of(field: str) -> Column:
        hits = F.filter("_f", lambda e: e["field"] == field)
        return F.get(hits, F.size(hits) - 1)["value"].alias(field)

    kept = [c for c in df.columns if c != cells]
    return rows.select(*kept, *[value_of(f) for f in HEADER_ALIASES])


def attach_invoice_header(
    lines: DataFrame, summary: DataFrame, debtors: DataFrame, month_start: Column
) -> DataFrame:
    """Order date and customer from the summary sheet; names fall back to the debtors master.

    `summary` is unique on invoice_id and `debtors` on customer_id, so no line is multiplied.
    """
    head = summary.select(
        "invoice_id",
        F.col("order_date").alias("_date"),
        F.col("customer_id").alias("_id"),
        F.col("customer_name").alias("_name"),
    )
    master = debtors.select(F.col("customer_id").alias("_mid"), F.col("customer_name").alias("_mname"))
    joined = lines.join(head, "invoice_id", "left").join(master, F.col("_id") == F.col("_mid"), "left")
    own_name = F.when(F.trim("_name") != "", F.col("_name"))
    return joined.withColumns(
        {
            "order_date": to_date("_date", month_start),
            "customer_id": F.coalesce("_id", F.lit("")),
            "customer_name": F.coalesce(own_name, F.col("_mname"), F.lit("")),
        }
    ).drop("_date", "_id", "_name", "_mid", "_mname")


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first of a total order."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.min(F.struct(*order, *rest)).alias("_r")
    return df.groupBy(*keys).agg(row).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in [*order, *rest]])
