"""Printed contents from text blocks (doc_id, page, x0, y0, x1, y1, size, text): lines, columns, entries, levels, places.

A page has few blocks, so what is clustered by the first block of a line is a fold over the page's sorted array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip

# What heads and foots of pages look like.
MARGIN = r"(?iU)^第.*页$|^Page\s*\d+$|^©|^版权所有|^CONTENTS$|^目\s*录$|^备查文件|^载有公司|^载有会计|^报告期内"
LEADERS = r"(?U)^[.·…\s]+$"
NUMBER = r"(?U)^\d+$"
CHAPTER = "^第[一二三四五六七八九十]+[章节]"
Y_REACH, X_GAP, PAIR_REACH, LARGE = 8.0, 200.0, 15.0, 20.0


def level(title: Column, x: Column | None = None, width: float = 595.0) -> Column:
    """0 for chapters, 1 for n.m and 一、, 2 for （一）; else 1 if indented by more than a fifth of the page, or 0."""
    by_name = F.when(title.rlike(CHAPTER), 0).when(title.rlike(r"(?U)^\d+\.\d+|^[一二三四五六七八九十]+、"), 1).when(title.rlike("^（[一二三四五六七八九十]+）"), 2)
    return by_name.otherwise(0) if x is None else by_name.when(x > width * 0.2, 1).otherwise(0)


def page_lines(blocks: DataFrame, reach: float = Y_REACH, gap: float = X_GAP) -> DataFrame:
    """(doc_id, page, line_no, x0, text): blocks at most ``reach`` below a line's first block are one line; where two of it are more than ``gap`` apart a new one starts."""
    item = F.struct("y0", "x0", "x1", "text")
    kind = "array<struct<y0:double,x0:double,x1:double,text:string,top:double>>"
    rows = blocks.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(item)).alias("items"))
    top = lambda acc, b: F.when((F.size(acc) > 0) & (b["y0"] - F.element_at(acc, -1)["top"] <= reach), F.element_at(acc, -1)["top"]).otherwise(b["y0"])
    put = lambda acc, b: F.concat(acc, F.array(F.struct(b["y0"], b["x0"], b["x1"], b["text"], top(acc, b)).cast(kind[6:-1])))
    each = rows.select("doc_id", "page", F.posexplode(F.aggregate("items", F.array().cast(kind), put)).alias("i", "b")).select("doc_id", "page", "i", "b.*")
    w = Window.partitionBy("doc_id", "page").orderBy("top", "x0", "i")
    new = (F.col("top") != F.lag("top").over(w)) | (F.col("x0") - F.lag("x1").over(w) > gap)
    lines = each.withColumn("line_no", F.sum(F.coalesce(new.cast("int"), F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "i", "text"))), lambda x: x["text"]), " ")
    return lines.groupBy("doc_id", "page", "line_no").agg(F.min("x0").alias("x0"), joined.alias("text"))


def multi_line_entries(lines: DataFrame) -> DataFrame:
    """(doc_id, page, title, target, level) of lines (doc_id, page, line_no, text): a bare number opens an entry, a chapter's number (the last) and other lines in order make its title."""
    t = strip(F.col("text"))
    useful = lines.withColumn("t", t).filter(~F.col("t").rlike(MARGIN) & ~F.col("t").rlike(LEADERS) & (F.col("t") != ""))
    w = Window.partitionBy("doc_id", "page").orderBy("line_no")
    number, chapter = F.col("t").rlike(NUMBER), F.col("t").rlike("^第[一二三四五六七八九十]+节")
    group = useful.withColumn("entry", F.sum(number.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("entry > 0")
    word = F.when(~number & ~chapter & (F.length("t") > 1), F.struct("line_no", "t"))
    made = group.groupBy("doc_id", "page", "entry").agg(
        F.max(F.when(number, F.col("t"))).cast("long").alias("target"), F.max(F.when(chapter, F.struct("line_no", "t")))["t"].alias("chapter"),
        F.array_join(F.transform(F.array_sort(F.collect_list(word)), lambda x: x["t"]), " ").alias("words"),
    )
    title = F.concat_ws(" ", "chapter", "words")
    return made.filter("words <> ''").select("doc_id", "page", title.alias("title"), "target", level(title).alias("level"))


def column_entries(blocks: DataFrame, reach: float = PAIR_REACH) -> DataFrame:
    """(doc_id, page, title, target, level): large numbers, from the top down, each take the nearest title less than ``reach`` away that none has taken."""
    t = strip(F.col("text"))
    mid = (F.col("y0") + F.col("y1")) / 2
    b = blocks.select("doc_id", "page", "x0", "y0", mid.alias("mid"), t.alias("t"), (t.rlike(NUMBER) & (F.col("size") > LARGE)).alias("number"))
    usable = b.filter(F.col("number") | (F.length("t") > 1) & ~F.col("t").rlike(NUMBER) & ~F.col("t").rlike(MARGIN))
    rows = usable.groupBy("doc_id", "page").agg(
        F.array_sort(F.collect_list(F.when(F.col("number"), F.struct("y0", "x0", "mid", "t")))).alias("numbers"),
        F.array_sort(F.collect_list(F.when(~F.col("number"), F.struct("y0", "x0", "mid", "t")))).alias("titles"),
    )
    kind = "array<struct<target:string,k:int>>"
    fold = F.expr(
        f"""aggregate(numbers, cast(array() as {kind}), (acc, n) -> concat(acc, array(named_struct('target', n.t, 'k', coalesce(array_min(filter(
          transform(titles, (x, i) -> named_struct('d', abs(x.mid - n.mid), 'k', i)), c -> c.d < {reach} AND NOT exists(acc, a -> a.k = c.k))).k, -1)))))"""
    )
    out = rows.select("doc_id", "page", "titles", F.explode(fold).alias("e")).filter("e.k >= 0").select("doc_id", "page", F.col("e.target").cast("long").alias("target"), F.get("titles", F.col("e.k")).alias("x"))
    return out.select("doc_id", "page", F.col("x.t").alias("title"), "target", level(F.col("x.t"), F.col("x.x0")).alias("level"))


def _bare(title: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(title, r"(?U)^第[一二三四五六七八九十]+[章节]\s*", ""), r"(?U)^\d+\.\d+\s*", ""))


def locate(entries: DataFrame, pages: DataFrame, start: int = 1, most: int = 100) -> DataFrame:
    """entries (doc_id, idx, title, page): those without a page get the first of ``most`` pages from ``start`` that holds
    ten characters of the title, the title without its number (from four characters), or, in its first 500 characters,
    fifteen of the title without blanks and commas; null if none. pages: doc_id, page_no, text."""
    lost = entries.filter("page IS NULL OR page <= 0")
    word = F.when(F.length(_bare(F.col("title"))) < 3, F.col("title")).otherwise(_bare(F.col("title")))
    tight = lambda c, n: F.regexp_replace(F.substring(c, 1, n), r"(?U)[\s、，.]", "")
    near = pages.filter(F.col("page_no").between(start, start + most - 1)).select("doc_id", "page_no", F.col("text").alias("body"))
    j = lost.select("doc_id", "idx", "title", word.alias("word")).join(near, "doc_id")
    held = F.contains("body", F.substring("title", 1, 10)) | ((F.length("word") >= 4) & F.contains("body", F.col("word"))) | F.contains(tight(F.col("body"), 500), tight(F.col("title"), 15))
    found = j.filter(held).groupBy("doc_id", "idx").agg(F.min("page_no").alias("found"))
    return entries.join(found, ["doc_id", "idx"], "left").select("doc_id", "idx", "title", F.coalesce(F.when(F.col("page") > 0, F.col("page")), "found").alias("page"))


def verify(chapters: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, idx, title, page, verified): whether the chapter's page holds ten characters of its title, six without its number, or its first word of two or more."""
    title = F.col("title")
    first = F.get(F.filter(F.split(strip(title), r"(?U)\s+"), lambda x: F.length(x) >= 2), F.lit(0))
    body = F.col("body")
    held = F.contains(body, F.substring(title, 1, 10)) | F.contains(body, F.substring(_bare(title), 1, 6)) | F.coalesce(F.contains(body, first), F.lit(False))
    p = pages.select("doc_id", F.col("page_no").alias("page"), F.col("text").alias("body"))
    return chapters.select("doc_id", "idx", "title", "page").join(p, ["doc_id", "page"]).select("doc_id", "idx", "title", "page", held.alias("verified"))
