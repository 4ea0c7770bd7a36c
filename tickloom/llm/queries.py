"""One query for each corpus operator, over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import imatch, language, licenses, minhash_dedup, mixing, packing, quality, secret_scan, sharding, toxicity


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_shard_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(documents(spark, sf_dir))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, sf_dir))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(documents(spark, sf_dir))


def op5_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_documents(documents(spark, sf_dir))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(documents(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


def op10_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_documents(documents(spark, sf_dir))


def queries():
    return {f.__name__: f for f in (op1_shard_balance, op2_minhash_dedup, op3_source_mix, op4_license_scan, op5_pack_sequences, op6_toxicity, op7_language_id, op8_secret_scan, op9_quality_rules, op10_imatch)}


def oracle_sql() -> dict[str, str]:
    return {"op2_minhash_dedup": minhash_dedup.ORACLE, "op3_source_mix": mixing.ORACLE, "op9_quality_rules": quality.ORACLE, "op10_imatch": imatch.ORACLE}
