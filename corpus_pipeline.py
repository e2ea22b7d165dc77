"""A training-data pipeline over ``documents``: each stage's result is written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.llm import bpe, decontaminate, order_minhash, quality, surrogate
from reportloom.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; a null or empty text has no words and goes. Repeated rows stay."""
    return quality.judge(docs, docs.columns).filter("kept").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the least doc_id, rows without one last; rows are told apart by doc_id and text, equal ones are one."""
    return order_minhash.first_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; one without doc_id stays, as no result could name it."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for private entities; n_chars follows the text."""
    done = surrogate.anonymise(docs)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of decoded texts."""
    return bpe.encode(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("bpe", encoding),
]

#: SQL expresses neither the rules' posterior nor the surrogates. tests/llm/test_pipeline.py holds run() against brute force on a small table (posterior and surrogates come from the operators).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
