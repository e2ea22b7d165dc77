"""Contents lines on odd inputs, and how often they are tested."""

import pytest

from reportloom.operators import contents
from reportloom.plans import queries as q

D = "/root/testdata/sf0.001"


def plan(spark, name):
    return q.QUERIES[name](spark, D)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["toc_lines", "toc_entries"])
def test_lines_tested_in_python(spark, name):
    p = plan(spark, name)
    assert "ArrowEvalPython" in p and "RLIKE" not in p and "regexp_extract" not in p


def test_entries_as_java(spark):
    lines = ["　公司治理 \x85", "第一节 公司简介 12", "第一节　甲乙丙丁....." + "0" * 5000 + "12\r", "公司治理 ２", "公司治理\r目录甲 3", "公司治理 1000", "第一节 12", "公司治理（续）乙…7\xa0", "公司治理 501", "公司治理1.12 3"]
    want = [(1, "第一节", "公司简介", 12), (2, "第一节", "甲乙丙丁", 12), (7, None, "公司治理乙", 7)]
    pages = spark.createDataFrame([(1, 2, "目录" + "\n".join(["", *lines])), (2, 1, None), (3, 1, ""), (4, 1, " \n")], "doc_id long, page_no int, text string")
    got = sorted(tuple(r) for r in contents.scanned(pages).collect())
    assert got == [(1, 200_001 + i, *e) for i, *e in want]
    assert sorted(map(tuple, contents.contents_pages(pages).collect())) == [(1, 2, 3, 11, True), (4, 1, 0, 1, False)]


def test_printed_lines_go_once(spark):
    """Both ways' tests in one step, and one window for all ways: 2 shuffles, of groups and of documents."""
    p = plan(spark, "toc_formats")
    assert p.count("FileScan") == 1 and p.count("Exchange") == 2 and p.count("ArrowEvalPython [") == 1 and "RLIKE" not in p


def test_cascade_has_one_window(spark):
    p = contents.by_cascade([(n, spark.createDataFrame([(1, n)], "doc_id int, x string"), 1) for n in ("a", "b")])
    assert p._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert [tuple(r) for r in p.select("doc_id", "method", "x").collect()] == [(1, "a", "a")]


def test_structure_on_odd_lines(spark):
    texts = {
        1: ["甲乙丙.....12", "　第一节 丁戊 7\r\n", "公司治理···7", "page 3", None, "···", "备查文件 9", "12", "第二节 己"],
        2: ["第一章 公司简介......", "释义和说明", "目 录\n", "3.1　治理…", "致辞 ", "甲 1"], 3: ["甲乙 1", "致辞致辞", None],
    }
    want = {(1, "standard", 0, "甲乙丙", 12), (1, "standard", 1, "第一节 丁戊", 7), (1, "standard", 2, "公司治理", 7)}
    want |= {(2, "pageless", i, t, -1) for i, t in ((0, "第一章 公司简介"), (1, "释义和说明"), (3, "3.1 治理"), (4, "致辞"))} | {(3, "columns", i, t, i) for i, t in enumerate(texts[3])}
    lines = spark.createDataFrame([(d, 1, i, t) for d, ts in texts.items() for i, t in enumerate(ts)], "doc_id int, page int, line_no int, text string")
    table = lines.select("doc_id", "page", "line_no", lines.text.alias("title"), lines.line_no.alias("target"))
    for columns in (table, (lines.text, lines.line_no)):
        assert {(r.doc_id, r.method, r.line_no, r.title, r.target) for r in contents.structure(lines, columns).collect()} == want
