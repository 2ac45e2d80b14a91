"""Tables in the folder that all executors share: cut lineage there, and remove what is no longer read."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

#: rows that travel to a Python worker at once; Spark's own limit is of 10,000 rows, whatever their length
BATCH_ROWS = 256
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Where that is unset, a folder of our own if all runs in one process (tests); a cluster must name one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = _own_dir()
    return base.rstrip("/")


@cache
def _own_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="storyloom-")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/storyloom-{name}-{uuid.uuid4().hex}"
    files, p = _file_system(spark, path)
    files.deleteOnExit(p)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more."""
    files, p = _file_system(spark, path)
    files.delete(p, True)


def cut(df: DataFrame, name: str = "cut", path: str | None = None) -> DataFrame:
    """``df`` computed once, as a table at ``path`` or a new one in the shared folder."""
    spark = df.sparkSession
    path = path or new_path(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")  # nothing reads the write's shuffle files again
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch to ``BATCH_ROWS``, so that a worker's memory does not follow the number of rows it has to do."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(BATCH_ROWS))


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p
