"""Contents pages in full: entries by line, fallback headings, outlines, page scores, formats, and the cascades that choose among them.

Inputs are tables of pages (doc_id, page_no, text), outlines (doc_id, idx, level, title, page), spans (doc_id, page, text, x0, y0, ...) and printed lines.
"""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scan import BLANKS, compiled, lists, remembered, texts_of
from ..functions.text import let, strip

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Patterns of entries, words that entries hold, words that rule one out, words of contents pages.
ENTRY = r"(?U)^(?:\s*(第[一二三四五六七八九十]+节)\s+)?(.+?)\s+(\d+)\s*$"
ENTRY_LOOSE = r"(?U)^(?:\s*(第[一二三四五六七八九十]+节)\s+)?(.+?)\s*[\.·…‥\-–—_\s]+(\d+)\s*$"
CONTINUED = "[（(]续[)）]"
CHAPTER_WORDS = "重要提示 目录 释义 公司简介 财务指标 管理层讨论 公司治理 环境 社会责任 重要事项 股份变动 股东情况 债券 财务报告 审计报告 备查文件 经营情况 董事会 监事会 高管 薪酬 关联交易 募集资金 重大合同"
NOT_ENTRIES = "年内召开 会议次数 环境信息依法披露 企业数量 塘环境技"
NOT_WITHOUT_NUMBER = "株冶"
PAGE_WORDS = ("目录", "CONTENTS", "内容", "目次", "章  节", "章节", "目 录")
HEADING = r"(?mU)^\s*(第[一二三四五六七八九十]+节|[一二三四五六七八九十]+、)(.+?)$"
FOOTERS = r"(?iU)^第.*页$|^Page\s*\d+$|^©|^版权所有|^CONTENTS$|^目\s*录$|^备查文件|^载有公司|^载有会计|^报告期内"
MARKS = (r"第[一二三四五六七八九十]+节", r"[一二三四五六七八九十]+、", r"（[一二三四五六七八九十]+）", r"\([一二三四五六七八九十]+\)", r"第[一二三四五六七八九十]+章", r"\d+\.\d+")
STANDALONE = ("重要提示", "备查文件目录", "行长致辞", "致辞", "目录", "释义", "公司简介")
# Fixed values of the second line test: patterns and words of its own.
PLAIN_ENTRY, PLAIN_ENTRY_LOOSE = r"(?U)^(.*?\S)\s+([0-9]{1,3})$", r"(?U)^(.*?\S)\s*[\.\·\-…]+\s*([0-9]{1,3})$"
PLAIN_WORDS = "重要提示 目录 释义 公司简介 会计数据 经营情况 管理层讨论 公司治理 环境 社会责任 重要事项 股份变动 债券 财务报告 备查文件 审计报告 资产负债表 利润表 现金流量 附注"


def _has(c: Column, words: str) -> Column:
    return c.rlike("|".join(words.split()))


def _refused(title: Column, numbered: Column) -> Column:
    return _has(title, NOT_ENTRIES) | (title.contains("原则") & (F.length(title) > 15)) | (title.startswith(NOT_WITHOUT_NUMBER) & ~numbered)


def _parts(line: Column, strict: str, loose: str, groups: int) -> Column:
    """array<string> of a line's groups by the strict pattern, else by the loose one."""
    of = lambda p: F.array(*[F.regexp_extract(line, p, g) for g in range(1, groups + 1)])
    return F.when(line.rlike(strict), of(strict)).otherwise(of(loose))


_STRICT, _LOOSE, _CONTINUED = compiled(ENTRY), compiled(ENTRY_LOOSE), compiled(CONTINUED)
_CHAPTERS, _NONE, _NAMED = (compiled("|".join(words)) for words in (CHAPTER_WORDS.split(), NOT_ENTRIES.split(), PAGE_WORDS))
_PAGE, _DIGIT, _YEAR, _DECIMALS = compiled("^0*[0-9]{1,3}$"), compiled(r"(?U)\d"), compiled(r"(?U)\d{4,}"), compiled(r"(?U)\.\d{2,}")


def entry(raw: str) -> tuple[str | None, str, int] | None:
    """(section_num, title, page) of a contents line, the strict pattern first; None if it is none or a filter refuses it."""
    line = raw.strip(BLANKS)
    if not line or line[-1] not in "0123456789":
        return None
    m = _STRICT.match(line) or _LOOSE.match(line)
    if not m or not _PAGE.match(m[3]):
        return None
    number, title, page = m[1], _CONTINUED.sub("", m[2]).strip(BLANKS), int(m[3].lstrip("0") or "0")
    if not (4 <= len(title) <= 50 and 1 <= page <= 500) or "年度报告" in line and ("目录" in line or "释义" in line):
        return None
    if _NONE.search(title) or "原则" in title and len(title) > 15 or len(_DIGIT.findall(title)) > 3 or _DECIMALS.search(title):
        return None
    if not number and (not _CHAPTERS.search(title) or title.startswith(NOT_WITHOUT_NUMBER) or _YEAR.search(title)):
        return None
    return number, title, page


def plain_entry(raw: Column) -> Column:
    """struct<title, page> by the second line test, with words and a digit share of its own; null if it is none."""

    def judged(title: Column, page: Column) -> Column:
        numbered = title.rlike("第[一二三四五六七八九十]+节")
        good = (
            F.length(title).between(4, 50) & page.between(1, 500) & ~_refused(title, numbered) & (numbered | _has(title, PLAIN_WORDS))
            & (F.regexp_count(title, F.lit(r"(?U)\d")) * 10 <= F.length(title) * 3) & ~title.rlike(r"\d{4}-\d{2}-\d{2}")
        )
        return F.when(good, F.struct(title.alias("title"), page.alias("page")))

    titled = lambda p: let(strip(p[0]), lambda title: judged(title, p[1].cast("int")))
    return let(strip(raw), lambda line: let(_parts(line, PLAIN_ENTRY, PLAIN_ENTRY_LOOSE, 2), titled))


def _page_reader():
    """A function of a page's text: (line number, entry) of its entries, how many lines it has, is_toc. A line is tested once, and again only if many others came between."""
    test = remembered(lambda line: [entry(line)])

    def read(text: str) -> tuple[list, int, bool]:
        ls = text.strip(BLANKS).split("\n")
        found = [(i, e) for i, line in enumerate(ls) if (e := test(line)[0])]
        valid = len(found)
        return found, len(ls), valid >= 3 and bool(_NAMED.search(text)) or valid >= 5 and valid * 10 >= len(ls) * 3

    return read


def contents_pages(pages: DataFrame) -> DataFrame:
    """(doc_id, page_no, valid, lines, is_toc): a contents page has one of its words and 3 entries, or 5 that are 3 in 10 of its lines."""
    read = _page_reader()

    @F.arrow_udf("struct<valid:int,lines:int,is_toc:boolean>")
    def judged(texts: pa.Array) -> pa.Array:
        rows = [read(t) for t in texts_of(texts)]
        return pa.StructArray.from_arrays([pa.array([len(r[0]) for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.bool_())], names=["valid", "lines", "is_toc"])

    x = pages.filter("text <> ''").select("doc_id", "page_no", judged.asNondeterministic()("text").alias("x"))
    return x.select("doc_id", "page_no", "x.valid", "x.lines", "x.is_toc")


def scanned(pages: DataFrame) -> DataFrame:
    """(doc_id, idx, section_num, title, page): the entries of all contents pages, page by page without a shuffle."""
    read = _page_reader()

    @F.arrow_udf("array<struct<i:int,section_num:string,title:string,page:int>>")
    def found(texts: pa.Array) -> pa.Array:
        rows = [x if toc else [] for x, _, toc in map(read, texts_of(texts))]
        flat = [(i, *e) for x in rows for i, e in x]
        kinds = {"i": pa.int32(), "section_num": pa.string(), "title": pa.string(), "page": pa.int32()}
        return lists([len(x) for x in rows], {k: pa.array([f[n] for f in flat], kind) for n, (k, kind) in enumerate(kinds.items())})

    y = pages.filter("text <> ''").select("doc_id", "page_no", F.explode(found.asNondeterministic()("text")).alias("y"))
    return y.select("doc_id", (F.col("page_no").cast("long") * 100_000 + F.col("y.i")).alias("idx"), "y.section_num", "y.title", "y.page")


def headings(pages: DataFrame) -> DataFrame:
    """(doc_id, idx, section_num, title, page): of each page the first numbered heading in its first five lines."""
    top = F.substring_index("text", "\n", 5)
    h = pages.filter(top.rlike(HEADING))
    return h.select("doc_id", F.col("page_no").cast("long").alias("idx"), F.regexp_extract(top, HEADING, 1).alias("section_num"), strip(F.regexp_extract(top, HEADING, 2)).alias("title"), F.col("page_no").cast("int").alias("page"))


def by_cascade(ways: list[tuple[str, DataFrame, int]]) -> DataFrame:
    """(doc_id, method, ...): of (method, entries, least number) each document's first way that gives so many entries; one shuffle and sort for all ways."""
    every = None
    for k, (name, rows, _) in enumerate(ways):
        rows = rows.withColumns({"method": F.lit(name), "_way": F.lit(k)})
        every = rows if every is None else every.unionByName(rows)
    whole = Window.partitionBy("doc_id")
    enough = [F.when(F.count_if(F.col("_way") == k).over(whole) >= max(least, 1), k) for k, (_, _, least) in enumerate(ways)]
    return every.withColumn("_first", F.coalesce(*enough)).filter("_way = _first").drop("_way", "_first")


def parse(pages: DataFrame, outline: DataFrame) -> DataFrame:
    """(doc_id, method, idx, section_num, title, page): a document's outline if it has 3 entries, else 3 or more scanned ones, else headings."""
    marks = outline.select("doc_id", F.col("idx").cast("long").alias("idx"), F.lit(None).cast("string").alias("section_num"), "title", F.col("page").cast("int").alias("page"))
    return by_cascade([("outline", marks, 3), ("text_scan", scanned(pages), 3), ("fallback", headings(pages), 1)])


def page_scores(spans: DataFrame, width: float = 595.0, most: int = 50) -> DataFrame:
    """(doc_id, page, points): pages (from 0, fewer than ``most``) that look like contents, 5 tenths or more; spans of fewer than 2 characters don't count."""
    s = spans.withColumn("text", strip(F.col("text"))).filter((F.length("text") >= 2) & (F.col("page") < most))
    g = s.groupBy("doc_id", "page").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y0", "x0", "text"))), lambda x: x["text"]), " ").alias("t"),
        F.count_if(F.col("text").rlike(r"(?U)^\d+$") & (F.col("x0") > 0.7 * width)).alias("right"), F.countDistinct(F.when(F.length("text") > 2, F.round("x0", 1))).alias("xs"),
    )
    n = lambda p: F.regexp_count("t", F.lit(p))
    marks = sum((n(f"(?U){m}") for m in MARKS[1:]), n(MARKS[0]))
    on = lambda c, k: F.when(c, k).otherwise(0)
    points = (
        on(F.col("t").rlike(r"(?iU)目\s*录|contents"), 3) + on(n(r"\.{3,}|···|…{2,}") >= 3, 2) + on(F.col("right") >= 3, 2) + on(F.col("xs") >= 3, 1) + on(marks >= 5, 2)
        + on(n(r"第[一二三四五六七八九十]+[章节].{2,20}?\.{3,}") >= 3, 3) + on(F.col("page").between(1, 10), 1)
    )
    return g.select("doc_id", "page", points.cast("long").alias("points")).filter("points >= 5")


def best_page(scores: DataFrame) -> DataFrame:
    """(doc_id, page, points): the page with most points, the first of equals."""
    best = scores.groupBy("doc_id").agg(F.min(F.struct((-F.col("points")).alias("neg"), "page")).alias("b"))
    return best.select("doc_id", "b.page", (-F.col("b.neg")).alias("points"))


def is_footer(text: Column) -> Column:
    return text.rlike(FOOTERS)


_FOOTER, _LEADERS, _NUMBER = compiled(FOOTERS), compiled(r"(?U)^[\.·…\s]+$"), compiled(r"(?U)^\d+$")
_STANDARD, _DOTS, _MIDDOTS = compiled(r"(?U)^(.+?)(?:\.{2,}|···|…+)?\s*(\d+)$"), compiled(r"\.{2,}$"), compiled("[·…]+$")
_PAGELESS = compiled(r"(?U)^(第[一二三四五六七八九十]+[章节]|\d+\.\d+)\s+(.+?)(?:\.{2,}|···|…+)?$")


def printed(text: str) -> tuple[str | None, str | None, str | None]:
    """(title, target, pageless title) of a printed line as an entry that ends in a page number and as one without; footers and leaders are neither."""
    t = text.strip(BLANKS)
    if not t or _FOOTER.search(text) or _LEADERS.match(t):
        return None, None, None
    title = target = None
    m = None if _NUMBER.match(t) else _STANDARD.match(t)
    if m:
        title = _MIDDOTS.sub("", _DOTS.sub("", m[1].strip(BLANKS))).strip(BLANKS)
        title, target = (title, m[2]) if len(title) >= 2 and not _NUMBER.match(title) else (None, None)
    m = _PAGELESS.match(t)
    if m:
        return title, target, f"{m[1]} {m[2].strip(BLANKS)}"
    return title, target, t if 2 < len(text) < 50 and any(x in text for x in STANDALONE) else None


def _tested(text: Column) -> Column:
    test = remembered(lambda line: list(printed(line)))

    @F.arrow_udf("struct<title:string,target:string,pageless:string>")
    def tested(texts: pa.Array) -> pa.Array:
        rows = [(None, None, None) if t is None else test(t) for t in texts_of(texts)]
        return pa.StructArray.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(3)], names=["title", "target", "pageless"])

    return tested.asNondeterministic()(text)


def standard_entries(lines: DataFrame) -> DataFrame:
    """(doc_id, page, line_no, title, target): printed lines that end in a page number, with leaders or without."""
    x = lines.select("doc_id", "page", "line_no", _tested(F.col("text")).alias("x")).filter("x.title IS NOT NULL")
    return x.select("doc_id", "page", "line_no", "x.title", F.col("x.target").cast("long").alias("target"))


def pageless_entries(lines: DataFrame) -> DataFrame:
    """(doc_id, page, line_no, title, target -1): numbered titles without a page number, and the usual titles that stand alone."""
    x = lines.select("doc_id", "page", "line_no", _tested(F.col("text")).alias("x")).filter("x.pageless IS NOT NULL")
    return x.select("doc_id", "page", "line_no", F.col("x.pageless").alias("title"), F.lit(-1).cast("long").alias("target"))


def structure(lines: DataFrame, columns: DataFrame | tuple[Column, Column]) -> DataFrame:
    """(doc_id, method, page, line_no, title, target): 3 or more standard entries, else 3 or more without pages, else those of a page in columns.

    ``columns``: entries of pages in columns, or, where every line is one, its title and target as columns of ``lines``.
    A line is tested once for both ways, and lines go through one window, in which each takes its document's way.
    """
    own = ["doc_id", "page", "line_no"]
    if isinstance(columns, tuple):
        title, target = columns
        rows = lines.select(*own, _tested(F.col("text")).alias("x"), F.lit(True).alias("c"), title.alias("c_title"), target.cast("long").alias("c_target"))
    else:
        none = F.lit(None)
        rows = lines.select(*own, _tested(F.col("text")).alias("x"), F.lit(False).alias("c"), none.cast("string").alias("c_title"), none.cast("long").alias("c_target"))
        rows = rows.unionByName(columns.select(*own, none.cast("struct<title:string,target:string,pageless:string>").alias("x"), F.lit(True).alias("c"), F.col("title").alias("c_title"), F.col("target").cast("long").alias("c_target")))
    whole = Window.partitionBy("doc_id")
    way = F.when(F.count("x.title").over(whole) >= 3, 0).when(F.count("x.pageless").over(whole) >= 3, 1).otherwise(2)
    y = rows.withColumn("way", way).filter((F.col("way") == 0) & F.col("x.title").isNotNull() | (F.col("way") == 1) & F.col("x.pageless").isNotNull() | (F.col("way") == 2) & F.col("c"))
    of = lambda *each: F.when(F.col("way") == 0, each[0]).when(F.col("way") == 1, each[1]).otherwise(each[2])
    title, target = of(F.col("x.title"), F.col("x.pageless"), F.col("c_title")), of(F.col("x.target").cast("long"), F.lit(-1).cast("long"), F.col("c_target"))
    return y.select(*own, title.alias("title"), target.alias("target"), of(F.lit("standard"), F.lit("pageless"), F.lit("columns")).alias("method"))


def readable(spans: DataFrame) -> DataFrame:
    """Spans with stripped text of 2 characters or more, with is_bold, center_x and width, in reading order within a page (order_no from 1); ties go by right edge and flags."""
    s = spans.withColumn("text", strip(F.col("text"))).filter(F.length("text") >= 2)
    w = Window.partitionBy("doc_id", "page").orderBy("y0", "x0", "text", "x1", "flags")
    return s.select("*", (F.col("flags").bitwiseAND(16) != 0).alias("is_bold"), ((F.col("x0") + F.col("x1")) / 2).alias("center_x"), (F.col("x1") - F.col("x0")).alias("width"), F.row_number().over(w).alias("order_no"))


def joined_pages(pages: DataFrame) -> DataFrame:
    """(doc_id, text): a document's pages in order, each under a line with its number."""
    page = F.concat(F.lit("--- Page "), F.col("page_no").cast("string"), F.lit(" ---\n"), F.coalesce("text", F.lit("")))
    p = pages.select("doc_id", "page_no", page.alias("t")).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_no", "t"))).alias("ps"))
    return p.select("doc_id", F.array_join(F.transform("ps", lambda x: x["t"]), "\n").alias("text"))


def slice_plan(chapters: DataFrame, prefix: str = "") -> DataFrame:
    """(doc_id, file, first, last): which pages make which file, named by number and title."""
    w = Window.partitionBy("doc_id").orderBy("start_page", "title", "end_page")
    name = F.substring(F.regexp_replace("title", r'[\\/:*?"<>|]', "_"), 1, 30)
    return chapters.select("doc_id", F.concat(F.lit(prefix), F.lpad(F.row_number().over(w).cast("string"), 2, "0"), F.lit("_"), name, F.lit(".pdf")).alias("file"), F.col("start_page").alias("first"), F.col("end_page").alias("last"))


def verified_share(chapters: DataFrame) -> DataFrame:
    """(doc_id, found, total) of chapters (doc_id, verified): their quotient is the rate of verification."""
    return chapters.groupBy("doc_id").agg(F.count_if("verified").alias("found"), F.count("*").alias("total"))
