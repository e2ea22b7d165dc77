"""Searches of whole texts, against Java's patterns and the SQL's results."""

from pyspark.sql import functions as F

from reportloom.functions import scan
from reportloom.operators import boundaries, financial, linescore, split
from reportloom.plans import queries as q


def test_merged_title_far_behind(spark, tmp_path):
    """The query seeks a title in the whole text, as its SQL does."""
    spark.createDataFrame([(12, "a word " * 30_000)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    text = q.reports(spark, str(tmp_path)).first().text
    got = {r.title: r.pos for r in q.QUERIES["merged_titles"](spark, str(tmp_path)).collect()}
    assert got == {"公司治理": text.index("第三节 公司治理"), "环境和社会责任": 100} and got["公司治理"] > 100_000


def test_hits_as_java(spark):
    texts = ["\n\n　审计报告 \n正文审计报告", "审计报告\r\n审计报告\x85 审计报告\n", "", None, "𠮷\n审计报告\n审计报告\n", "x\r\n 审计报告 \r\n", "第一节\x1c审计报告 第一节　审计报告"]
    tests = [("审计报告", p) for p in (r"(?U)(?:^|\n)\s*审计报告\s*\n", r"(?mU)^\s*审计报告\s*$", "(?m)^审计报告$", r"(?U)第[一二]+节\s+审计报告")]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, text string").cache()
    got = {(r.i, r.k, r.at, r.hit) for r in docs.select("i", F.inline(scan.hits(F.col("text"), tests))).collect()}
    want = set()
    for k, (_, p) in enumerate(tests):
        want |= {(r.i, k, r.at, r.hit) for r in docs.select("i", F.inline(split.matches(F.col("text"), F.lit(p)))).collect()}
    assert got == want and len(got) > 8


def test_places_not_overlapping(spark):
    docs = spark.createDataFrame([("aaaa𠮷aa", ["aa", "", None, "b"]), (None, ["a"])], "text string, titles array<string>")
    assert [r[0] for r in docs.select(scan.all_places(F.col("text"), F.col("titles"))).collect()] == [[[0, 2, 5], [], [], []], [[]]]


def test_searches_read_texts_once(spark):
    """No pattern is put together for each row: the searches are one step of the plan."""
    r = spark.createDataFrame([(1, "第一节 公司治理")], "doc_id long, text string")
    for df in (boundaries.content_points(r), financial.deep_split_lines(r)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" in plan and "regexp_extract_all" not in plan


def test_normalised_as_java(spark):
    from reportloom.functions.text import newlines, strip

    texts = ["﻿a\r\n\r\rb\t 　c\n\n\n\n\nd\n12第一节 x\r3第二章\x8512第一节", " \x1c\n", "", None, "1第一节"]
    t = F.regexp_replace(F.translate(newlines(F.col("text")), "　", " "), "[\t ]+", " ")
    t = F.regexp_replace(F.regexp_replace(t, "\n{4,}", "\n\n\n"), "(?m)^\\d+(第[一二三四五六七八九十]+[节章])", "$1")
    docs = spark.createDataFrame([(x,) for x in texts], "text string")
    rows = docs.select(F.concat(strip(t), F.lit("\n")).alias("want"), linescore.normalised(F.col("text")).alias("got")).collect()
    assert [r.got for r in rows] == [r.want for r in rows]


def test_line_scores_in_one_row(spark):
    for name in ("line_scored_candidates", "line_scored_sections"):
        plan = q.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("FileScan") == 1
