"""What the operators share: tables in the shared folder, batches of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storyloom.plans.lineage import BATCH_ROWS, cut, new_path, remove, shared_dir, small_batches

__all__ = ["BATCH_ROWS", "counted", "few", "new_path", "remove", "shared_dir", "small_batches", "source", "write_table"]

#: rows for which a task of its own pays
TASK_ROWS = 100_000


def source(rows: DataFrame, **columns: tuple[str, str]) -> DataFrame:
    """``rows`` as just these columns: name = (column, type). Lowers the session's Arrow batch to ``BATCH_ROWS``, so that a worker's memory does not follow the length of texts."""
    small_batches(rows.sparkSession)
    return rows.select(*[F.col(c).cast(kind).alias(name) for name, (c, kind) in columns.items()])


def write_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back. Removed when the application ends, or by ``remove``."""
    return cut(df, name, path)


def counted(df: DataFrame, name: str, path: str | None = None) -> tuple[DataFrame, int]:
    """``write_table`` with the number of rows, taken while they are written."""
    seen = Observation()
    return write_table(df.observe(seen, F.count(F.lit(1)).alias("n")), name, path), seen.get["n"]


def few(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most ``rows`` rows, in no more tasks than two a core or one for ``TASK_ROWS``, whichever is more: a session's shuffle partitions may be many times that, each with a task and a file of its own.

    Partitions stay whole, and a task does its partitions one behind the other, so its memory is that of one."""
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)))
