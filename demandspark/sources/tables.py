"""Table scans, sinks and registration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type names of the JSON column specs.
SPEC_TYPES = {
    "STRING": T.StringType(),
    "INT64": T.LongType(),
    "INTEGER": T.LongType(),
    "FLOAT64": T.DoubleType(),
    "FLOAT": T.DoubleType(),
    "BOOL": T.BooleanType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}


def schema_from_spec(spec: list[dict]) -> T.StructType:
    """`[{name, type, mode}]` to a StructType; REQUIRED means not null."""
    return T.StructType(
        [T.StructField(c["name"], SPEC_TYPES[c["type"].upper()], c.get("mode") != "REQUIRED") for c in spec]
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header; a given schema avoids the inference pass."""
    reader = spark.read.option("header", True).option("nullValue", "")
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def missing_required(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Null count of every REQUIRED column, as (column_name, null_count)."""
    required = [f.name for f in schema.fields if not f.nullable]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.unpivot([], required, "column_name", "null_count")


def read(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Parquet or NDJSON scan."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.format(fmt).load(path)


def write(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by: list[str] | None = None
) -> None:
    """Parquet or gzipped NDJSON; overwrite or append."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "json":
        writer = writer.option("compression", "gzip")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header row, NULL as empty text."""
    df.write.mode(mode).option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    path: str | None = None,
    bucket_by: list[str] | None = None,
    buckets: int = 200,
) -> None:
    """Managed or external table; `bucket_by` co-locates later joins on those keys."""
    writer = df.write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)


def register(name: str, df: DataFrame) -> DataFrame:
    """Temporary view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def with_version(df: DataFrame, version: str = "V1", col: str = "model_version") -> DataFrame:
    """Add the version column, or fill its gaps."""
    current = F.col(col) if col in df.columns else F.lit(None).cast("string")
    return df.withColumn(col, F.coalesce(current, F.lit(version)))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of several tables."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out


def head(df: DataFrame, n: int, *order) -> DataFrame:
    """The first n rows of an explicit order."""
    return df.orderBy(*order).limit(n)


def select_available(df: DataFrame, cols: list[str]) -> DataFrame:
    """The listed columns that exist."""
    return df.select([c for c in cols if c in df.columns])
