"""Boundaries as (doc_id, pos, title, canonical, confidence): content points, merging, missing ones, merged titles.

A document has few boundaries, so what depends on those taken before is a fold over one sorted array of them.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scan import first_place, hits, small_batches

# Sections in order: aliases, and where in a text each is expected.
DEFINITIONS = {
    "重要提示_目录_释义": ("重要提示 目录 释义 备查文件", 0, 10000), "公司简介和主要财务指标": ("公司简介 主要财务指标 公司信息", 0, 20000),
    "管理层讨论与分析": ("管理层讨论与分析 经营情况讨论 董事会报告", 10000, 100000), "公司治理": ("公司治理 股东大会 董事会 监事会", 50000, 150000),
    "环境和社会责任": ("环境 社会责任 ESG 环境保护", 50000, 150000), "重要事项": ("重要事项 重大事项 利润分配 关联交易", 100000, 200000),
    "股份变动及股东情况": ("股份变动 股东情况 股本变动 股东总数", 200000, 300000), "债券相关情况": ("债券 可转债 公司债券", 200000, 350000),
    "财务报告": ("财务报告 审计报告 财务报表 合并资产负债表", 200000, 500000),
}
# Words behind a section's number that mark its content, and one plain title.
CONTENT = {
    "重要提示_目录_释义": "重要提示 释义", "公司简介和主要财务指标": "公司简介 主要财务指标", "管理层讨论与分析": "管理层讨论 经营情况讨论", "公司治理": "公司治理", "环境和社会责任": "环境 社会责任",
    "重要事项": "重要事项 重大事项", "股份变动及股东情况": "股份变动 股东情况", "债券相关情况": "债券", "财务报告": "财务报告 审计报告",
}
PLAIN = {"重要提示_目录_释义": ("重要提示、目录和释义",)}
# Titles of two sections in one.
MERGED = {"公司治理、环境和社会": ("公司治理", "环境和社会责任")}
NUMBERED = r"(?U)第[一二三四五六七八九十]+节\s+"
_KIND = "array<struct<s:int,p:int,pos:int,title:string,canonical:string,confidence:double>>"


def _found(docs: DataFrame, patterns: list[tuple[int, int, str, str, str]], definitions=DEFINITIONS) -> DataFrame:
    """(doc_id, s, p, pos, title, canonical) of all matches of (section, pattern number, word, name, pattern) where the section is expected; a plain test for the word spares most patterns."""
    small_batches(docs.sparkSession)
    kind = [F.struct(*[F.lit(v).alias(n) for n, v in zip(("s", "p", "word", "name", "lo", "hi"), (s, p, word, name, *definitions[name][1:]))]) for s, p, word, name, _ in patterns]
    found = docs.select("doc_id", F.explode(hits(F.col("text"), [(word, pattern) for _, _, word, _, pattern in patterns])).alias("m"))
    found = found.select("doc_id", "m.at", F.get(F.array(*kind), F.col("m.k")).alias("k"))
    return found.filter(F.col("at").between(F.col("k.lo"), F.col("k.hi"))).select("doc_id", "k.s", "k.p", F.col("at").alias("pos"), F.col("k.word").alias("title"), F.col("k.name").alias("canonical"))


def content_points(docs: DataFrame, definitions=DEFINITIONS) -> DataFrame:
    """(doc_id, pos): for each pattern its first expected match that isn't within 1000 of a point taken (in the first 5000 characters) or within 2000 behind one."""
    patterns = []
    for s, (name, words) in enumerate(CONTENT.items()):
        patterns += [(s, p, w, name, NUMBERED + re.escape(w)) for p, w in enumerate(words.split(" "))]
        patterns += [(s, 10 + p, w, name, re.escape(w)) for p, w in enumerate(PLAIN.get(name, ()))]
    rows = _found(docs, patterns, definitions).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("s", "p", "pos"))).alias("items"))
    kind = "array<struct<s:int,p:int,pos:int>>"
    clash = lambda a, c: ((a["s"] == c["s"]) & (a["p"] == c["p"])) | ((c["pos"] < 5000) & (F.abs(a["pos"] - c["pos"]) < 1000)) | ((a["pos"] < c["pos"]) & (c["pos"] - a["pos"] < 2000))
    fold = F.aggregate("items", F.array().cast(kind), lambda acc, c: F.when(F.exists(acc, lambda a: clash(a, c)), acc).otherwise(F.concat(acc, F.array(c.cast(kind[6:-1])))))
    return rows.select("doc_id", F.explode(F.array_distinct(F.transform(fold, lambda a: a["pos"]))).alias("pos"))


def merge_near(boundaries: DataFrame, distance: int = 5000) -> DataFrame:
    """Boundaries after merging: a neighbour of the same section within ``distance`` yields to the higher confidence, then each section keeps its most confident, the first of equals."""
    item = F.struct("pos", "canonical", "confidence")
    kind = "array<struct<pos:int,canonical:string,confidence:double>>"
    rows = boundaries.select("doc_id", F.col("pos").cast("int"), "canonical", F.col("confidence").cast("double")).groupBy("doc_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    last = lambda acc: F.element_at(acc, -1)
    one = lambda c: F.array(c.cast(kind[6:-1]))
    step = lambda acc, c: (
        F.when((F.size(acc) == 0) | (last(acc)["canonical"] != c["canonical"]) | (c["pos"] - last(acc)["pos"] >= distance), F.concat(acc, one(c)))
        .when(c["confidence"] > last(acc)["confidence"], F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), one(c)))
        .otherwise(acc)
    )
    merged = rows.select("doc_id", F.explode(F.aggregate("items", F.array().cast(kind), step)).alias("b"))
    best = merged.groupBy("doc_id", F.col("b.canonical").alias("canonical")).agg(F.min(F.struct((-F.col("b.confidence")).alias("c"), F.col("b.pos").alias("pos"))).alias("b"))
    return best.select("doc_id", F.col("b.pos").alias("pos"), "canonical", (-F.col("b.c")).alias("confidence"))


def fill_missing(docs: DataFrame, boundaries: DataFrame, away: int = 10000, definitions=DEFINITIONS) -> DataFrame:
    """(doc_id, pos, canonical, confidence): the boundaries, and for sections without one the first match of an alias where
    it is expected and at least ``away`` from all others, with confidence 0.5. Sections go in catalogue order."""
    patterns = []
    for s, (name, (words, _, _)) in enumerate(definitions.items()):
        for a, w in enumerate(words.split(" ")):
            patterns += [(s, 2 * a, w, name, NUMBERED + re.escape(w)), (s, 2 * a + 1, w, name, rf"(?mU)^\s*{re.escape(w)}\s*$")]
    found = _found(docs, patterns, definitions).withColumn("confidence", F.lit(0.5))
    item = F.struct("s", "p", "pos", "title", "canonical", "confidence")
    have = boundaries.select("doc_id", F.lit(-1).alias("s"), F.lit(0).alias("p"), F.col("pos").cast("int"), F.lit("").alias("title"), "canonical", F.col("confidence").cast("double"))
    rows = have.unionByName(found).groupBy("doc_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    clash = lambda a, c: (a["canonical"] == c["canonical"]) | (F.abs(a["pos"] - c["pos"]) < away)
    fold = F.aggregate("items", F.array().cast(_KIND), lambda acc, c: F.when((c["s"] >= 0) & F.exists(acc, lambda a: clash(a, c)), acc).otherwise(F.concat(acc, F.array(c.cast(_KIND[6:-1])))))
    return rows.select("doc_id", F.explode(fold).alias("b")).select("doc_id", "b.pos", "b.canonical", "b.confidence")


def canonical_name(title: Column, definitions=DEFINITIONS) -> Column:
    """The first section whose name or an alias holds the title without its number or is held by it; null if none."""
    bare = F.regexp_replace(title, NUMBERED, "")
    both = lambda w: bare.contains(w) | F.contains(F.lit(w), bare)
    tests = []
    for name, (words, _, _) in definitions.items():
        hit = both(name)
        for w in words.split(" "):
            hit = hit | both(w)
        tests.append(F.when(hit, F.lit(name)))
    return F.coalesce(*tests)


def split_merged(docs: DataFrame, boundaries: DataFrame, reach: int | None = 100000) -> DataFrame:
    """(doc_id, pos, title, canonical, confidence): a title of two sections becomes two boundaries with nine tenths of its
    confidence, each at its part's own title within ``reach`` behind it (None: to the end of the text), or else 100 characters apart."""
    parts = F.coalesce(*[F.when(F.col("title").contains(k), F.array(*[F.lit(p) for p in ps])) for k, ps in MERGED.items()])
    b = boundaries.select("doc_id", F.col("pos").cast("int").alias("pos"), "title", "canonical", F.col("confidence").cast("double").alias("confidence")).withColumn("parts", parts)
    plain = b.filter("parts IS NULL").drop("parts")
    two = b.filter("parts IS NOT NULL").select("doc_id", "pos", "confidence", F.posexplode("parts").alias("i", "part")).join(docs.select("doc_id", "text"), "doc_id")
    area = F.substring(F.col("text"), F.col("pos") + 1, F.length("text") if reach is None else F.lit(reach))
    small_batches(docs.sparkSession)
    own = {p: [NUMBERED + p, rf"(?U)[一二三四五六七八九十]+、\s*{p}", f"(?m)^{p}$"] for ps in MERGED.values() for p in ps}
    at = first_place(area, F.col("part"), own)
    return plain.unionByName(two.select("doc_id", (F.col("pos") + F.coalesce(at, F.col("i") * 100)).alias("pos"), F.col("part").alias("title"), canonical_name(F.col("part")).alias("canonical"), (F.col("confidence") * 0.9).alias("confidence")))
