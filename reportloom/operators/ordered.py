"""Ordered operators: regions by gaps, islands of pages, chapter ends, nearest keys, de-duplication by distance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def regions(points: DataFrame, key: str, at: str, gap: int, pad: int = 0) -> DataFrame:
    """(key, lo, hi, n): runs of points no more than ``gap`` apart, padded."""
    w = Window.partitionBy(key).orderBy(at)
    new = (F.col(at) - F.lag(at).over(w) > gap).cast("int")
    island = F.sum(F.coalesce(new, F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return points.withColumn("_island", island).groupBy(key, "_island").agg((F.min(at) - pad).alias("lo"), (F.max(at) + pad).alias("hi"), F.count("*").alias("n")).drop("_island")


def longest_run(pages: DataFrame, key: str, physical: str, printed: str, gap: int = 5) -> DataFrame:
    """(key, first, last, n): the longest chain of printed page numbers, the first of equals."""
    w = Window.partitionBy(key).orderBy(physical)
    p, q = F.col(physical) - F.lag(physical).over(w), F.col(printed) - F.lag(printed).over(w)
    broken = F.when((p <= gap) & q.between(0, gap), 0).otherwise(1)
    island = F.sum(broken).over(w.rowsBetween(Window.unboundedPreceding, 0))
    runs = pages.withColumn("_i", island).groupBy(key, "_i").agg(F.min(physical).alias("first"), F.max(physical).alias("last"), F.count("*").alias("n"))
    best = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "first"))
    return runs.withColumn("_b", best).filter("_b = 1").drop("_b", "_i")


def chapter_ends(toc: DataFrame, key: str, last: int, levels: int = 4) -> DataFrame:
    """toc (key, idx, level, page) with end_page: the page before the next entry of the same or a higher level (0 is the highest of ``levels``).

    For each level a window looks for the next entry at that level; the nearest of those that aren't deeper is taken. No join.
    """
    ahead = Window.partitionBy(key).orderBy("idx").rowsBetween(1, Window.unboundedFollowing)
    next_of = lambda k: F.first(F.when(F.col("level") == k, F.struct("idx", "page")), ignorenulls=True).over(ahead)
    t = toc.withColumns({f"_n{k}": next_of(k) for k in range(levels)})
    nearest = F.least(*[F.when(F.col("level") >= k, F.col(f"_n{k}")) for k in range(levels)])
    return t.select(key, "idx", "level", "page", F.greatest(F.coalesce(nearest["page"] - 1, F.lit(last)), F.col("page")).alias("end_page"))


def spread(points: DataFrame, key: str, at: str, distance: int) -> DataFrame:
    """(key, at): points at least ``distance`` from the last one kept."""
    kept = points.groupBy(key).agg(F.array_sort(F.collect_list(at)).alias("_a"))
    fold = F.aggregate("_a", F.array().cast("array<bigint>"), lambda acc, x: F.when((F.size(acc) == 0) | (x - F.element_at(acc, -1) >= distance), F.concat(acc, F.array(x.cast("bigint")))).otherwise(acc))
    return kept.select(key, F.explode(fold).alias(at))


def best_by(rows: DataFrame, keys: list[str], *order) -> DataFrame:
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_r = 1").drop("_r")


def ordered_concat(rows: DataFrame, key: str, at: str, text: str, sep: str = "") -> DataFrame:
    """Pieces of each key joined in order."""
    return rows.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, text))), lambda x: x[text]), sep).alias(text))


def without(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't done yet: resumption by an anti-join."""
    return rows.join(done.select(key), key, "left_anti")
