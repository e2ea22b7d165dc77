"""Audits of a run's section table (doc_id, number, size) and differences of two runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def frequency(files: DataFrame, dim: DataFrame) -> DataFrame:
    """How many files each standard section has, its coverage of documents in per mille, and a flag."""
    docs = files.agg(F.countDistinct("doc_id").alias("docs"))
    n = files.groupBy("number").agg(F.count("*").alias("n"))
    out = F.broadcast(dim).join(n, "number", "left").crossJoin(F.broadcast(docs)).withColumn("n", F.coalesce("n", F.lit(0)))
    flag = F.when(F.col("n") * 100 < F.col("docs") * 50, "WARN-L").when(F.col("n") * 100 < F.col("docs") * 90, "WARN-M").otherwise("OK")
    return out.select("number", "n", "docs", flag.alias("flag"))


def size_stats(files: DataFrame) -> DataFrame:
    """Count, least, greatest, upper median, whole mean and tiny ones (< 200) of each section's sizes.

    Files are counted by (number, size) first, so the window runs over distinct sizes, not over files.
    """
    sizes = files.groupBy("number", "size").agg(F.count("*").alias("k"))
    own = Window.partitionBy("number")
    upto = F.sum("k").over(own.orderBy("size"))
    r = sizes.withColumn("upto", upto).withColumn("total", F.sum("k").over(own))
    middle = F.expr("total div 2 + 1")
    return r.groupBy("number").agg(
        F.sum("k").alias("n"), F.min("size").alias("least"), F.max("size").alias("greatest"),
        F.max(F.when((F.col("upto") >= middle) & (F.col("upto") - F.col("k") < middle), F.col("size"))).alias("median"),
        F.expr("sum(size * k) div sum(k)").alias("mean"), F.coalesce(F.sum(F.when(F.col("size") < 200, F.col("k"))), F.lit(0)).alias("tiny"),
    )


def count_distribution(files: DataFrame) -> DataFrame:
    per = files.groupBy("doc_id").agg(F.countDistinct("number").alias("sections"))
    return per.groupBy("sections").agg(F.count("*").alias("docs"))


def missing(files: DataFrame, dim: DataFrame) -> DataFrame:
    """(doc_id, number, is_core, is_optional) of standard sections that a document lacks."""
    return files.select("doc_id").distinct().crossJoin(F.broadcast(dim)).join(files.select("doc_id", "number").distinct(), ["doc_id", "number"], "left_anti").select("doc_id", "number", "is_core", "is_optional")


def missing_patterns(files: DataFrame, dim: DataFrame) -> DataFrame:
    per = missing(files, dim).groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list("number")), "+").alias("pattern"))
    return per.groupBy("pattern").agg(F.count("*").alias("docs"))


def missing_core(files: DataFrame, dim: DataFrame) -> DataFrame:
    return missing(files, dim).filter("is_core").groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list("number")), "+").alias("core"), F.count("*").alias("n"))


def optional_missing(files: DataFrame, dim: DataFrame) -> DataFrame:
    return missing(files, dim).filter("is_optional").groupBy("number").agg(F.count("*").alias("docs"))


def most_missing(files: DataFrame, dim: DataFrame, k: int = 10) -> DataFrame:
    return missing(files, dim).groupBy("doc_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "doc_id").limit(k)


def coverage_change(a: DataFrame, b: DataFrame) -> DataFrame:
    """Documents with each section in two runs, and the trend."""
    x = a.groupBy("number").agg(F.countDistinct("doc_id").alias("v2"))
    y = b.groupBy("number").agg(F.countDistinct("doc_id").alias("v3"))
    both = x.join(y, "number", "full").select("number", F.coalesce("v2", F.lit(0)).alias("v2"), F.coalesce("v3", F.lit(0)).alias("v3"))
    return both.withColumn("delta", F.col("v3") - F.col("v2")).withColumn("trend", F.when(F.col("delta") > 0, "up").when(F.col("delta") < 0, "down").otherwise("same"))


def gained(a: DataFrame, b: DataFrame) -> DataFrame:
    """(doc_id, number) that only the second run has, of documents in both."""
    return b.select("doc_id", "number").distinct().join(a.select("doc_id").distinct(), "doc_id", "left_semi").join(a, ["doc_id", "number"], "left_anti")


def size_changes(a: DataFrame, b: DataFrame, more_than: int = 1000, k: int = 20) -> DataFrame:
    j = a.select("doc_id", "number", F.col("size").alias("v2_size")).join(b.select("doc_id", "number", F.col("size").alias("v3_size")), ["doc_id", "number"])
    return j.withColumn("delta", F.col("v3_size") - F.col("v2_size")).filter(F.abs("delta") > more_than).orderBy(F.abs("delta").desc(), "doc_id", "number").limit(k)


def status_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Full outer join of two runs' (doc_id, status)."""
    return a.select("doc_id", F.col("status").alias("v2_status")).join(b.select("doc_id", F.col("status").alias("v3_status")), "doc_id", "full")


def of_successes(details: DataFrame, files: DataFrame) -> DataFrame:
    """Section files of documents that were split with success; documents without files drop out."""
    return files.join(details.filter("status = 'success'").select("doc_id").distinct(), "doc_id", "left_semi")


METRICS = ("total_files", "success", "warning", "failed", "ignored_summary", "ignored_low_quality")


def run_metrics(details: DataFrame) -> DataFrame:
    """(metric, value): a run's documents, in all and by status."""
    g = details.agg(F.count("*").alias("total_files"), *[F.count_if(F.col("status") == m).alias(m) for m in METRICS[1:]])
    return g.unpivot([], list(METRICS), "metric", "value")


def metric_deltas(a: DataFrame, b: DataFrame) -> DataFrame:
    """(metric, v2, v3, delta) of two runs' metrics; one that a run lacks counts as 0."""
    both = a.select("metric", F.col("value").alias("v2")).join(b.select("metric", F.col("value").alias("v3")), "metric", "full")
    both = both.select("metric", F.coalesce("v2", F.lit(0)).alias("v2"), F.coalesce("v3", F.lit(0)).alias("v3"))
    return both.withColumn("delta", F.col("v3") - F.col("v2"))


def first_few(changes: DataFrame, k: int = 5) -> DataFrame:
    """(number, place, doc_id): the first ``k`` documents of each section that gained or lost it."""
    place = F.row_number().over(Window.partitionBy("number").orderBy("doc_id"))
    return changes.withColumn("place", place).filter(F.col("place") <= k).select("number", "place", "doc_id")


def attempts_summary(attempts: DataFrame) -> DataFrame:
    """total documents, successful and failed attempts: a document that failed first counts in both."""
    return attempts.agg(F.countDistinct("doc_id").alias("total"), F.count_if(F.col("status") == "success").alias("success"), F.count_if(F.col("status") == "failed").alias("failed"))


def latest(attempts: DataFrame) -> DataFrame:
    """Each document's last attempt."""
    return attempts.groupBy("doc_id").agg(F.max(F.struct("attempt", "status", "error")).alias("x")).select("doc_id", "x.attempt", "x.status", "x.error")
