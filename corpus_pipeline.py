"""From raw documents to packed sequences: toxic documents go, one of each group of near duplicates stays, secrets are
blanked, sources are mixed to target weights, and what results is packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import minhash_dedup, mixing, packing, secret_scan, toxicity
from tickloom.llm.common import materialize, release, scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, fitted on the labelled ones among them, does not reject."""
    chain = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.classify(docs, chain).where("not rejected").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates, and every document outside such groups; repeated rows once."""
    docs = docs.withColumn("_row", minhash_dedup.row_key())
    return docs.join(minhash_dedup.first_rows(docs), "_row", "left_semi").dropDuplicates(["_row"]).drop("_row")


def blank_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets (also encoded ones) replaced in text; n_chars follows."""
    out = secret_scan.redacted(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("secrets") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated at their source's rate, in random order."""
    return mixing.replicate(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all copies, placed in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", blank_secrets),
    ("mixing", mix),
    ("packing", pack),
]

#: A fitted classifier and a tokenizer are not SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        with scratch(spark) as kept:
            docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
            kept.append(docs)
        release(spark, *before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
