"""The registered queries of the training-data operators and the SQL that some of them have."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from storyloom.llm import convrepair, decontam, filteraudit, htmltext, neardup, packing, pii, quality, runtime, sharding, simhash, subdedup, tokencount, tokenout

SHARDS, SLOTS = 64, 65537


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subdedup.remove_repeats(_table(spark, sf_dir, "documents"), with_text=False)


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = runtime.new_path(spark, "ids")
    tokenout.write_token_ids(_table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return tokenout.manifest(spark, path)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(_table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS, SLOTS).select("doc_id", "slot", "shard")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(_table(spark, sf_dir, "pages"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convrepair.repair(convrepair.damaged(_table(spark, sf_dir, "conversations")))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_substring_dedup, op2_minhash_dedup, op3_packing, op4_token_counts, op5_quality_rules, op6_decontamination, op7_token_ids, op8_sharding, op9_html_text, op10_pii,
        op11_conversation_repair, op12_filter_audit, op13_simhash_dedup,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    from storyloom.llm import sql

    return sql.oracle_sql()
