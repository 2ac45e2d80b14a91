"""Sorts, pages, samples and global row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storyloom.plans.lineage import cut


def global_index(rows: DataFrame, order: str | list[str], name: str = "idx") -> DataFrame:
    """``rows`` with their place from 0 in the given order.

    Range partitioning sorts in parallel; each range counts on its own, and the counts of the ranges - one row per
    partition - are summed and joined back. The ranges are kept first: range bounds are sampled, so computing them twice
    could give different ones. Only ties in all order columns are in no fixed order.
    """
    keys = [order] if isinstance(order, str) else order
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, *keys).withColumn("_part", F.spark_partition_id())
    local = cut(ranged.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(*keys))))
    sizes = local.groupBy("_part").agg(F.count("*").alias("_size"))
    before = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_base"))
    return local.join(F.broadcast(before), "_part").withColumn(name, (F.col("_base") + F.col("_n") - 1).cast("long")).drop("_part", "_n", "_base")


def page(rows: DataFrame, order: list[Column], limit: int = 50, offset: int = 0) -> DataFrame:
    """One page of at most 200 rows."""
    return rows.orderBy(*order).offset(max(0, offset)).limit(min(200, max(1, limit)))


def hash_order(seed: int | str, key: str) -> Column:
    """A fixed pseudo-random order of keys."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def sample(rows: DataFrame, n: int, key: str, seed: int | str = 0) -> DataFrame:
    """n rows, the same for one seed, in the order of the key."""
    return rows.orderBy(hash_order(seed, key), key).limit(n).orderBy(key)


def shuffle(rows: DataFrame, key: str, seed: int | str = 42) -> DataFrame:
    return rows.orderBy(hash_order(seed, key), key)


def batches(rows: DataFrame, size: int, order: str, part: list[str] | None = None, name: str = "batch") -> DataFrame:
    """Rows with a batch number; inside each key of ``part`` if given."""
    if part:
        return rows.withColumn(name, F.floor((F.row_number().over(Window.partitionBy(*part).orderBy(order)) - 1) / size).cast("long"))
    return global_index(rows, order, "_i").withColumn(name, F.floor(F.col("_i") / size).cast("long")).drop("_i")


def keyword_order(files: DataFrame, keywords: list[str], name: str = "name") -> DataFrame:
    """Files whose names contain a keyword, each once with its first keyword's number, ordered by that and name. A scan, no join."""
    first = F.coalesce(*[F.when(F.contains(F.col(name), F.lit(k)), F.lit(i)) for i, k in enumerate(keywords)])
    return files.withColumn("keyword", first).where("keyword is not null").orderBy("keyword", name)
