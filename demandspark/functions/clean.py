"""Scalar cleaning expressions and row normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .calendar import as_col

# Text that stands for a missing value.
NULL_WORDS = ("nan", "none", "null")

# Ordinal codes of the customer segments and buyer types.
SEGMENT_CODES = {"Small Retailer": 1, "Medium Retailer": 2, "Large Retailer": 3, "Bulk/Wholesale": 4}
BUYER_CODES = {
    "Occasional Buyer": 1,
    "Regular Buyer": 2,
    "Frequent Buyer": 3,
    "High-Value Buyer": 4,
    "Bulk Buyer": 5,
}


def safe_div(a: Column | str, b: Column | str) -> Column:
    """P20: NULL where the divisor is zero."""
    return F.try_divide(as_col(a), as_col(b))


def exceeds(score: Column, limit: float) -> Column:
    """Whether a score of deviations is above the limit; one that is at it but for rounding is not.

    A deviation's last digits depend on the order in which rows are summed.
    """
    return score > limit * (1 + 1e-12)


def clip(c: Column | str, lo=None, hi=None) -> Column:
    """Bounds that keep NULL as NULL."""
    value = as_col(c)
    out = value
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(value.isNotNull(), out)


def to_number(c: Column | str, default=None) -> Column:
    """Invalid text becomes NULL, or `default`."""
    number = as_col(c).try_cast("double")
    return number if default is None else F.coalesce(number, F.lit(float(default)))


def to_date(c: Column | str, fallback: Column) -> Column:
    """Unparsable or missing dates take the fallback (first day of the source month)."""
    return F.coalesce(as_col(c).try_cast("date"), fallback)


def sku_code(c: Column | str, strict: bool = True) -> Column:
    """Numeric codes as integer text; others are dropped (strict) or kept trimmed."""
    raw = as_col(c)
    code = F.trim(raw).try_cast("double").try_cast("bigint").cast("string")
    return code if strict else F.coalesce(code, F.trim(raw))


def sku_clean(df: DataFrame, col: str) -> DataFrame:
    """Letters and digits only; empty and null words are dropped."""
    cleaned = df.withColumn(col, F.regexp_replace(F.trim(F.col(col)), "[^a-zA-Z0-9]", ""))
    return cleaned.where((F.col(col) != "") & ~F.lower(F.col(col)).isin(*NULL_WORDS))


def strip_prefix(c: Column | str, prefix: str) -> Column:
    """P04."""
    value = as_col(c)
    return F.when(value.startswith(prefix), F.substr(value, F.lit(len(prefix) + 1))).otherwise(value)


def add_prefix(c: Column | str, prefix: str) -> Column:
    """P04."""
    return F.concat(F.lit(prefix), as_col(c).cast("string"))


def normalise_lines(df: DataFrame) -> DataFrame:
    """Raw text lines (sku, quantity, price, total) to typed sales lines.

    A missing total is quantity times price; a zero price with a total is total over quantity.
    """
    typed = df.withColumns(
        {
            "sku": sku_code("sku"),
            "quantity": to_number("quantity"),
            "unit_price": to_number("price", 0),
            "line_total": to_number("total"),
        }
    ).where(F.col("sku").isNotNull() & (F.col("quantity") > 0))
    total = F.coalesce("line_total", F.col("quantity") * F.col("unit_price"))
    price = F.when(
        (F.col("unit_price") == 0) & (total > 0), safe_div(total, "quantity")
    ).otherwise(F.col("unit_price"))
    return typed.withColumns({"line_total": total, "unit_price": price}).drop("price", "total")


def category_levels(path: Column | str) -> tuple[Column, Column, Column]:
    """Second part, third part (else the second), last part; `Unknown` where absent."""
    parts = F.filter(F.transform(F.split(as_col(path), "/"), lambda x: F.trim(x)), lambda x: x != "")
    second = F.coalesce(F.get(parts, F.lit(1)), F.lit("Unknown"))
    third = F.coalesce(F.get(parts, F.lit(2)), second)
    last = F.coalesce(F.get(parts, F.size(parts) - 1), F.lit("Unknown"))
    return second, third, last


def leaf_category(path: Column | str, default: str = "Unknown") -> Column:
    """Last element of the path."""
    parts = F.filter(F.split(as_col(path), "/"), lambda x: F.trim(x) != "")
    return F.coalesce(F.get(parts, F.size(parts) - 1), F.lit(default))


def map_code(c: Column | str, mapping: dict, default=None) -> Column:
    """A short literal lookup with a fallback value or column."""
    chain = None
    for key, value in mapping.items():
        chain = F.when(as_col(c) == key, value) if chain is None else chain.when(as_col(c) == key, value)
    return chain.otherwise(default) if default is not None else chain


def ordinal(c: Column | str, mapping: dict[str, int], other: int = 0) -> Column:
    """Enum text to its code."""
    return map_code(c, mapping, F.lit(other))


def clean_nulls(df: DataFrame) -> DataFrame:
    """Null words in text and non-finite numbers become NULL."""
    fixes = {}
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            fixes[field.name] = F.when(~F.lower(F.trim(c)).isin(*NULL_WORDS), c)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            finite = ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
            fixes[field.name] = F.when(finite, c)
    return df.withColumns(fixes)


def list_literal(c: Column | str) -> Column:
    """`['592', '573']` to an array of texts."""
    bare = F.regexp_replace(as_col(c), r"[\[\]'\"\s]", "")
    return F.filter(F.split(bare, ","), lambda x: x != "")


def list_text(c: Column | str) -> Column:
    """`['592', '573']` to `592, 573`."""
    return F.array_join(list_literal(c), ", ")


def standard_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_").replace(".", "")


def standard_names(df: DataFrame) -> DataFrame:
    """Lower-case names, spaces to underscores, dots removed."""
    return df.toDF(*[standard_name(c) for c in df.columns])


def integral_ids(df: DataFrame, cols: list[str]) -> DataFrame:
    """P25: float ids to integers where the value is integral, else NULL."""
    return df.withColumns({c: F.when(F.col(c) % 1 == 0, F.col(c).try_cast("bigint")) for c in cols})


def feature_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """NULL features take a constant or another column (given as `Column`)."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), d if isinstance(d, Column) else F.lit(d)) for c, d in defaults.items()}
    )


def presence(c: Column | str) -> Column:
    """NULL / EMPTY / HAS_ID."""
    value = as_col(c)
    return F.when(value.isNull(), "NULL").when(value == "", "EMPTY").otherwise("HAS_ID")


def fmt_number(c: Column | str, prefix: str = "", digits: int = 0) -> Column:
    """Thousands separators and an optional currency prefix."""
    return F.concat(F.lit(prefix), F.format_number(as_col(c), digits))


def complete_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows with every listed feature present."""
    return df.dropna(subset=cols)
