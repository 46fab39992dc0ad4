"""What the operators of this subpackage share: keys, text functions, tables in the shared folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE_WORD = r"[^\x20\x09-\x0D]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_own_folder: list[str] = []
_open: dict[str, SparkSession] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; a local one of its own only where that is unset, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor reaches")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="llm-"))
    return _own_folder[0]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet; it goes when the session ends or with `drop`."""
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    _open[path] = spark
    return path


def written(df: DataFrame, name: str, few_files: bool = False) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage ends there, whatever executor is lost later.

    The shuffle files of the writing job are removed when it has ended, since only the table is read afterwards.
    With `few_files`, for tables far smaller than the input, the last tasks are as many as four for each core.
    """
    spark = df.sparkSession
    schema = df.schema
    if few_files:
        df = df.coalesce(4 * spark.sparkContext.defaultParallelism)
    path = fresh_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    table = spark.read.schema(schema).parquet(path)
    table.scratch_path = path
    return table


def drop(*tables: DataFrame) -> None:
    """Delete tables made by `written` that no result reads any more."""
    for table in tables:
        remove(table.sparkSession, table.scratch_path)


def opened() -> set[str]:
    """The paths of the tables there are now, for `drop_since`."""
    return set(_open)


def drop_since(before: set[str], *keep: DataFrame) -> None:
    """Delete all tables written since, but those to keep: what a finished step leaves behind."""
    kept = {table.scratch_path for table in keep}
    for path, spark in list(_open.items()):
        if path not in before and path not in kept:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Also after the session has stopped, as long as its JVM runs."""
    context, jvm = spark.sparkContext, SparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    conf = context._jsc.hadoopConfiguration() if context._jsc else jvm.org.apache.hadoop.conf.Configuration()
    where.getFileSystem(conf).delete(where, True)
    _open.pop(path, None)


def exists(spark: SparkSession, path: str) -> bool:
    where = SparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


@atexit.register
def remove_all() -> None:
    """At the end of the program: tables that lazy results may still have read until now."""
    for path, spark in list(_open.items()):
        try:
            remove(spark, path)
        except Exception:  # the session is gone, and with it the way to the folder
            return


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of a few megabytes, however long they are; the session keeps the setting."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is; `lower` alone would also change letters beyond ASCII."""
    replaced = text
    for a, b in zip(UPPER, LOWER):
        replaced = F.replace(replaced, F.lit(a), F.lit(b))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(replaced)


def extract_all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def whole(text: str = "text") -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(text), F.lit(""))


def text_key(text: str = "text") -> Column:
    """Sets apart rows that repeat a doc_id with another text."""
    return F.xxhash64(whole(text))


def only(docs: DataFrame, decided: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of `docs` with (or, for left_anti, without) their doc_id and text_key in `decided`; null ids match."""
    side = decided.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(side, side["_id"].eqNullSafe(docs["doc_id"]) & (side["_key"] == key), how)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
