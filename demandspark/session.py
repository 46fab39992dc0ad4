"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "demandspark", **conf: str) -> SparkSession:
    """A session with the library's settings; cluster settings come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cpu_tasks(spark: SparkSession) -> int:
    """Tasks for work that is heavy on CPU but small in bytes; byte-based coalescing would leave one."""
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(wanted, 2 * spark.sparkContext.defaultParallelism)


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings of any session that runs these operators.

    Week arithmetic must not depend on the submitting machine's zone. A hot key is split
    at join time also where the next aggregation would have reused the join's partitions.
    """
    wanted = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    for key, value in wanted.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`; a temporary folder only for a local master."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="demandspark-"))
        current = context.getCheckpointDir()
    return current


_written: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; it is deleted when the program ends, or by `clear`."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _written[path] = spark
    return path


def clear() -> None:
    """Delete everything under the paths handed out so far."""
    for path, spark in list(_written.items()):
        context, jvm = spark.sparkContext, SparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        conf = context._jsc.hadoopConfiguration() if context._jsc else jvm.org.apache.hadoop.conf.Configuration()
        where.getFileSystem(conf).delete(where, True)
        del _written[path]


@atexit.register
def clear_at_exit() -> None:
    try:
        clear()
    except Exception:  # the session is gone, and with it the way to the folder
        _written.clear()


def pin(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: later uses see the same rows, whatever executor is lost.

    A table instead of a checkpoint keeps column pruning and a true size for join planning.
    """
    path = scratch_path(df.sparkSession, "pinned")
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.pinned_path = path
    return table


def unpin(*tables: DataFrame) -> None:
    """Delete tables made by `pin` that nothing reads any more."""
    for table in tables:
        drop_folder(table.sparkSession, table.pinned_path)
        _written.pop(table.pinned_path, None)


def drop_folder(spark: SparkSession, path: str | None) -> None:
    """Delete a folder of the shared file system that this program wrote."""
    if path:
        where = SparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
