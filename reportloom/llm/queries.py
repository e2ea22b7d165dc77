"""The queries of this subpackage and their DuckDB SQL, for __spark_entry__.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, order_minhash, quality, revisit, sharding, suffix_dedup, surrogate, toxicity, window_dedup
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, sf_dir, "documents")).drop("kept")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), ["doc_id"])


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.classes(table(spark, sf_dir, "documents"))


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogate.anonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.deduplicate(table(spark, sf_dir, "documents")).drop("kept_text")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisit.resolve_revisits(revisit.records_of_pages(table(spark, sf_dir, "pages")))
    return found.withColumn("headers", revisit.header_text(found["headers"]))


def queries() -> dict[str, Query]:
    return {
        "op1_suffix_array_dedup": op1_suffix_array_dedup,
        "op2_quality_rules": op2_quality_rules,
        "op3_bpe": op3_bpe,
        "op4_sharding": op4_sharding,
        "op5_toxicity": op5_toxicity,
        "op6_order_minhash": op6_order_minhash,
        "op7_pii_surrogates": op7_pii_surrogates,
        "op8_window_dedup": op8_window_dedup,
        "op9_benchmark_decontamination": op9_benchmark_decontamination,
        "op10_warc_revisits": op10_warc_revisits,
    }


def oracle_sql() -> dict[str, str]:
    return {"op9_benchmark_decontamination": decontaminate.ORACLE_SQL, "op10_warc_revisits": revisit.ORACLE_SQL}
