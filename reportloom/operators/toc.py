"""Page maps, slices by contents entries, sub-sections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

def nearest(left: DataFrame, right: DataFrame, key: str, at: str, value: str, reach: int) -> DataFrame:
    """left (key, at) with the value of the nearest right row, at most ``reach`` away (the smaller of equals): buckets of ``reach`` make it an equi-join."""
    b = lambda c: F.floor(F.col(c) / F.lit(reach))
    l = left.withColumn("_b", b(at))  # noqa: E741
    r = right.select(F.col(key), F.col(at).alias("_at"), F.col(value), F.explode(F.array(b(at) - 1, b(at), b(at) + 1)).alias("_b"))
    j = l.join(r, [key, "_b"], "left").withColumn("_d", F.abs(F.col(at) - F.col("_at"))).withColumn("_ok", F.col("_d") <= reach)
    best = F.row_number().over(Window.partitionBy(key, at).orderBy(F.desc_nulls_last("_ok"), "_d", "_at"))
    return j.withColumn("_r", best).filter("_r = 1").select(key, at, F.when(F.col("_ok"), F.col(value)).alias(value))


def page_slices(pages: DataFrame, entries: DataFrame) -> DataFrame:
    """(doc_id, title, text): pages from an entry's page up to the next entry's, joined by blank lines; of entries on one page all but the last have none.

    Entries and pages go through one window by page, in which every page takes the last entry at or before it, so nothing is joined by range.
    """
    w = Window.partitionBy("doc_id").orderBy("page", "title")
    e = entries.select("doc_id", "title", "page").withColumn("next", F.lead("page").over(w)).filter("next IS NULL OR next > page")
    marks = e.select("doc_id", F.col("page").alias("page_no"), F.lit(0).alias("kind"), "title", F.lit(None).cast("string").alias("text"))
    rows = marks.unionByName(pages.select("doc_id", F.col("page_no").cast(marks.schema["page_no"].dataType).alias("page_no"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("title"), "text"))
    near = F.last("title", ignorenulls=True).over(Window.partitionBy("doc_id").orderBy("page_no", "kind").rowsBetween(Window.unboundedPreceding, 0))
    start = F.last(F.when(F.col("kind") == 0, F.col("page_no")), ignorenulls=True).over(Window.partitionBy("doc_id").orderBy("page_no", "kind").rowsBetween(Window.unboundedPreceding, 0))
    own = rows.withColumn("near", near).withColumn("from", start).filter("kind = 1 AND near IS NOT NULL")
    return own.groupBy("doc_id", "near", "from").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "text"))), lambda x: x["text"]), "\n\n").alias("text")).select("doc_id", F.col("near").alias("title"), "text")


def sub_sections(sections: DataFrame, aliases: DataFrame) -> DataFrame:
    """(doc_id, sub, start, end): the first line of fewer than 50 characters with an alias of each sub-section, closed by the next."""
    from .split import line_index

    # sections are read once: their sizes go with their lines
    whole = F.max("total").over(Window.partitionBy("doc_id"))
    sized = line_index(sections.select("doc_id", F.col("content").alias("text")), F.length("text").alias("total"), keep=F.length("line") < 50)
    lines = sized.withColumn("total", whole)
    hit = lines.join(F.broadcast(aliases), F.expr("contains(line, alias)")).groupBy("doc_id", "sub").agg(F.min("start").alias("start"), F.max("total").alias("total"))
    w = Window.partitionBy("doc_id").orderBy("start", "sub")
    return hit.select("doc_id", "sub", "start", F.coalesce(F.lead("start").over(w), F.col("total")).alias("end"))
