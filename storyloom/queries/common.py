"""Inputs shared by queries: the tables, and views of them in the shapes the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, pos, role, content)."""
    return table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("pos"), "role", F.col("text").alias("content"))


#: every third turn from the first is the system's, the next the user's, then the assistant's: gives adjacent equal roles after merging by speaker
DERIVED_ROLE = "CASE WHEN pos % 5 IN (0, 1) THEN 'system' WHEN pos % 5 = 2 THEN 'user' ELSE 'assistant' END"


def derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with roles that repeat: two for the system, one for the user, two for the assistant."""
    return turns(spark, sf_dir).withColumn("role", F.expr(DERIVED_ROLE))


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, messages)."""
    from storyloom.operators.messages import to_arrays

    return to_arrays(turns(spark, sf_dir), "conv_id")


def exploded(arrays: DataFrame, key: str, messages: str = "messages") -> DataFrame:
    """(key, pos, role, content) of message arrays, scalar columns only."""
    return arrays.select(key, F.posexplode(messages).alias("pos", "m")).select(key, F.col("pos").cast("long").alias("pos"), "m.role", "m.content")


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, pos, line): lines of documents that are not blank, trimmed."""
    from storyloom.operators.messages import text_lines

    return text_lines(table(spark, sf_dir, "documents"), "doc_id").withColumn("pos", F.col("pos").cast("long"))


SQL_LINES = r"""
WITH raw AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS ls FROM documents WHERE trim(coalesce(text, '')) <> ''),
lines AS (SELECT doc_id, CAST(i - 1 AS BIGINT) AS pos, ls[i] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM raw))
"""
