"""Cleaning of extracted text; every step is a column expression over a document's lines."""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scan import BLANKS, small_batches, texts_of, translated
from ..functions.text import strip


def lines(c: Column) -> Column:
    return F.split(c, "\n", -1)


def without_vertical(c: Column) -> Column:
    """Lines of one or two letters, digits or Han characters go: text that was set vertically."""
    return F.array_join(F.filter(lines(c), lambda x: ~x.rlike(r"(?U)^\s*[A-Za-z0-9一-鿿]{1,2}\s*\z")), "\n")


def without_page_numbers(c: Column) -> Column:
    """Bare page numbers, numbers between dashes, and contents lines with dot leaders go."""
    ends = lambda x: F.right(F.rtrim(x, F.lit(" \t\x0b\f\r\x85\u2028\u2029")), F.lit(1)).between("0", "9")
    gap = r"[ \t\x0B\f\r]*"
    alone = rf"(?U)^\s*(?:[0-9]{{1,4}}|[-—]{gap}[0-9]{{1,4}}{gap}[-—])\s*\z"
    return F.array_join(F.filter(lines(c), lambda x: ~(x.rlike(alone) | ends(x) & x.rlike(r"[.．…·]{6,}\s*\d+\s*$"))), "\n")


def few_blank_lines(c: Column, most: int = 2) -> Column:
    """At most ``most`` blank lines in a row."""
    return F.regexp_replace(c, r"(\n[ \t]*){%d,}\n" % (most + 1), "\n" * (most + 1))


def blanks(c: Column) -> Column:
    """Ideographic blanks to spaces, runs of spaces to one."""
    return F.regexp_replace(F.regexp_replace(c, "　", " "), "[ \t]{2,}", " ")


def repeated_headers(docs: DataFrame, more_than: int = 5) -> DataFrame:
    """(doc_id, line, n): lines of 10 to 60 characters that occur more than ``more_than`` times in a document and are no section title."""
    each = docs.select("doc_id", F.explode(lines(F.col("text"))).alias("raw")).select("doc_id", strip(F.col("raw")).alias("line")).filter(F.length("line") > 3)
    n = each.groupBy("doc_id", "line").agg(F.count("*").alias("n"))
    return n.filter((F.col("n") > more_than) & F.length("line").between(10, 60) & ~F.col("line").rlike("第[一二三四五六七八九十]+节"))


# Running headers, and a section's own title.
HEADERS = r"202[5-6].*年度报告|年度报告.*202[5-6]|^\d+$|股份有限公司.*202|第[一二三四五六七八九十]+节.*（续）"
TITLE = r"(?U)第[一二三四五六七八九十]+节\s+[^\n（续）]{2,30}"


def without_headers(docs: DataFrame) -> DataFrame:
    """docs with blank lines for running headers and footers, and removed, the number of them: repeated lines and HEADERS, titles excepted unless they are continued."""
    small_batches(docs.sparkSession)
    gap = "[^\n\r\x85\u2028\u2029]*"
    headers, title = re.compile(HEADERS.replace(".*", gap).replace("$", r"\Z"), re.A), re.compile(translated(TITLE))
    section, number = re.compile("第[一二三四五六七八九十]+节"), re.compile(rf"\d{{2,}}[{BLANKS}]*\Z")

    def marked(text: str | None) -> tuple[str | None, int | None]:
        if text is None:
            return None, None
        raw = text.split("\n")
        bare = [x.strip(BLANKS) for x in raw]
        often = {x for x, n in Counter(bare).items() if n > 5 and 10 <= len(x) <= 60 and not section.search(x)}

        def header(x: str) -> bool:
            if title.search(x):
                if "（续）" in x:
                    return True
                if not number.search(x):
                    return False
            return x in often or bool(headers.search(x))

        flags = [header(x) for x in bare]
        return "\n".join("\n" if f else x for x, f in zip(raw, flags)), sum(flags)

    @F.arrow_udf("struct<text:string,removed:int>")
    def made(texts: pa.Array) -> pa.Array:
        rows = [marked(t) for t in texts_of(texts)]
        return pa.StructArray.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32())], names=["text", "removed"])

    d = docs.withColumn("_marked", made.asNondeterministic()(F.col("text")))
    return d.withColumns({"text": F.col("_marked.text"), "removed": F.col("_marked.removed")}).drop("_marked")


def cid_count(c: Column) -> Column:
    """Undecoded glyphs; more than 100 are worth a warning."""
    return F.regexp_count(c, F.lit(r"\(cid:\d+\)"))


def quality_score(docs: DataFrame) -> DataFrame:
    """(doc_id, score): 100 less penalties for undecoded glyphs, blank lines, short lines and missing titles."""
    t = F.coalesce("text", F.lit(""))
    ls = lines(t)
    n = F.size(ls)
    blank = F.size(F.filter(ls, lambda x: strip(x) == ""))
    cid = F.regexp_count(t, F.lit(r"\(cid:\d+\)")) * 1000 > F.length(t)
    score = 100 - F.when(cid, 30).otherwise(0) - F.when(blank * 2 > n, 20).otherwise(0) - F.when(F.length(t) < n * 20, 15).otherwise(0) - F.when(~t.rlike("第[一二三四五六七八九十]+节"), 10).otherwise(0)
    return docs.select("doc_id", F.greatest(score, F.lit(0)).cast("long").alias("score"))


def clean(docs: DataFrame) -> DataFrame:
    """docs with cleaned text, the length after each step, undecoded glyphs and removed headers."""
    d = docs.withColumns({"len_0": F.length("text"), "cids": cid_count(F.col("text"))})
    d = d.withColumn("text", without_vertical(F.col("text"))).withColumn("len_1", F.length("text"))
    d = without_headers(d).withColumn("len_2", F.length("text"))
    for k, step in enumerate((without_page_numbers, few_blank_lines, blanks), 3):
        d = d.withColumn("text", step(F.col("text"))).withColumn(f"len_{k}", F.length("text"))
    return d
