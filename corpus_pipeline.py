"""The corpus pipeline: quality rules, near-dedup, decontamination, redaction and packing of ``documents``.

Every stage takes tables of any columns besides those of ``documents`` and gives those of ``documents`` only (the last one pieces); an
empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm import decontam, neardup, packing, pii, quality
from storyloom.llm.queries import vocabulary
from storyloom.llm.runtime import write_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the compression bands keep. Null and empty texts have no words and go; repeated rows are judged each; a null id changes nothing."""
    return quality.quality_filter(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8 or more): the one with the smallest id, once if its row is repeated.

    An id that has several texts keeps each of them if it is its group's smallest. Rows with a null id stay.
    """
    docs = docs.select(*COLUMNS)
    gone = neardup.near_duplicates(docs, percent=80).where("not kept").select(F.col("doc_id").alias("gone")).distinct()
    again = docs.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("again"))
    kept = docs.join(gone, F.col("doc_id") == F.col("gone"), "left_anti")
    # only rows whose id is repeated meet by their texts
    once = kept.join(again, F.col("doc_id") == F.col("again"), "left_anti")
    repeated = kept.join(again, F.col("doc_id") == F.col("again"), "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(repeated)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. Null and empty texts hold none and stay; repeated rows and rows with a null id are searched like others."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows the text. A null text stays null, and its n_chars with it; repeated rows stay repeated."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 ids. A null or empty text is the end id alone; repeated rows are packed each."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontamination", decontamination), ("personal_data", personal_data), ("packing", packed)]

#: packing and near-dedup have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
