"""A synthetic corpus of Chinese reports, by SQL that Spark and DuckDB read alike: one variant for each remainder of doc_id by 12."""

from __future__ import annotations

_FILL = "repeat('公司业务稳定发展持续经营。', {n})"
_LF = "chr(10)"


def _body(titles: list[str], n: int = 60) -> str:
    return " || ".join(f"'{t}' || {_LF} || {_FILL.format(n=n)} || {_LF}" for t in titles)


_MAIN = ["第一节 公司简介和主要财务指标", "第二节 管理层讨论与分析", "第三节 公司治理", "第四节 重要事项", "第五节 股份变动及股东情况", "第六节 财务报告"]
#: A document's whole text, and as much Chinese text as the quality gate asks for beside it.
_WHOLE = "coalesce(text, '')"
_LEAD = f"'示例股份有限公司' || {_LF} || {_WHOLE} || {_LF} || {_FILL.format(n=f'90 + CAST(floor(length({_WHOLE}) / 40) AS INT)')} || {_LF}"
_TOC = " || ".join(f"'{t}........{k * 9}' || {_LF}" for k, t in enumerate(_MAIN, 1))
_PLAIN = " || ".join(f"'{t}      {k * 9}' || {_LF}" for k, t in enumerate(_MAIN, 1))
_BARE = [t.split(" ")[1] for t in _MAIN]
VARIANTS = (
    f"{_LEAD} || {_body(_MAIN)}",
    f"{_TOC} || {_LEAD} || {_body(_MAIN)}",
    f"{_PLAIN} || {_LEAD} || {_body(_MAIN)}",
    f"{_LEAD} || {_body(_BARE)}",
    f"{_LEAD} || {_body([*_MAIN[:5], '第六节 财 务 报 告'])}",
    f"{_LEAD} || {_body([_MAIN[0], _MAIN[3], _MAIN[1], *_MAIN[4:]])}",
    f"{_LEAD} || {_body(['  ' + _BARE[0], '    ' + _BARE[1], *_MAIN[2:]])}",
    f"CASE WHEN doc_id % 24 = 7 THEN '年度报告摘要' || {_LF} ELSE repeat('行' || {_LF}, 30) || '年度报告摘要' || {_LF} END || {_LEAD} || {_body(_MAIN)}",
    f"CASE doc_id % 3 WHEN 0 THEN '短文' WHEN 1 THEN repeat('(cid:12)字', 300) ELSE coalesce(text, '') || repeat('latin only ', 80) END",
    f"{_LEAD} || {_body([*_MAIN, '十二、关联交易'])}",
    f"{_LEAD} || {_body(_MAIN[:5])} || '獨立核數師報告' || {_LF} || '正文。' || {_LF} || {_body(['第六节 财务报告', '第七节 审计报告'], 20)}",
    f"{_LEAD} || {_body(_MAIN[:5])} || repeat('财务报告' || {_LF} || '详见第三节财务报告' || {_LF}, 25) || {_body(['第六节 财务报告'])}",
)
REPORTS = "SELECT doc_id, CASE doc_id % 12 " + " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(VARIANTS)) + " END AS text FROM documents"

_SHORT = _FILL.format(n=8)
_TABLE = f"CASE WHEN doc_id % 3 = {{k}} THEN '说明文字' ELSE '编制单位:示例' END || {_LF}"
_STATEMENTS = ["合并资产负债表", "母公司资产负债表", "合并利润表", "合并现金流量表", "合并所有者权益变动表"]
#: Financial reports: statements with or without tables, then notes, some of them risky.
FINANCIALS = (
    f"SELECT doc_id, CASE doc_id % 5 WHEN 4 THEN {_WHOLE} || '编制单位' || {_LF} || repeat({_SHORT} || '编制单位' || {_LF}, CAST(doc_id % 9 AS INT)) ELSE '序言' || {_LF} || {_WHOLE} || {_LF} || '审计报告' || {_LF} || {_SHORT} || {_LF} || "
    + " || ".join(f"'{s}' || {_LF} || {_TABLE.format(k=k % 3)} || repeat({_SHORT}, 6) || {_LF}" for k, s in enumerate(_STATEMENTS))
    + f" || CASE WHEN doc_id % 4 = 1 THEN '' ELSE '财务报表附注' || {_LF} END || '一、公司概况' || {_LF} || {_SHORT} || {_LF} || '五、存货' || {_LF} || {_SHORT} || {_LF} || '十一、关联方及关联交易' || {_LF} || {_SHORT} END AS text FROM documents"
)
#: Text blocks of printed pages, from line items.
BLOCKS = """SELECT l_orderkey AS doc_id, 1 AS page, CAST(l_partkey % 4 * 130 AS DOUBLE) AS x0, CAST(l_linenumber * 7 + l_suppkey % 5 AS DOUBLE) AS y0, CAST(l_partkey % 4 * 130 + 40 AS DOUBLE) AS x1,
 CAST(l_linenumber * 7 + l_suppkey % 5 + 10 AS DOUBLE) AS y1, CAST(CASE WHEN l_partkey % 2 = 0 THEN 24 ELSE 10 END AS DOUBLE) AS size,
 CASE l_partkey % 4 WHEN 0 THEN CAST(l_suppkey AS VARCHAR(20)) WHEN 1 THEN '第一节 标题' || l_linenumber WHEN 2 THEN CAST(l_linenumber AS VARCHAR(20)) ELSE '（一）小节' || l_suppkey END AS text FROM lineitem"""
#: Lines of contents pages, one for each order and line number.
CONTENTS_LINES = """SELECT k AS doc_id, 1 AS page, idx AS line_no, CASE s % 4 WHEN 0 THEN CAST(s AS VARCHAR(20)) WHEN 1 THEN '第' || substr('一二三四五六七', CAST(idx AS INT), 1) || '节' WHEN 2 THEN '公司治理' || idx ELSE '· · ·' END AS text FROM lines"""
#: Pages with contents, headings or neither, one for each order and line number, and outlines of some documents.
_S = "CAST(s % 300 + 1 AS VARCHAR(9))"
PAGES = (
    "SELECT k AS doc_id, CAST(idx AS INT) AS page_no, CASE s % 6 "
    f"WHEN 0 THEN '目录' || {_LF} || '第一节 重要提示、目录和释义 ' || {_S} || {_LF} || '  第二节 公司简介........' || {_S} || {_LF} || '股东情况（续） 12' || {_LF} || '第三节 公司治理 1000' "
    f"WHEN 1 THEN '第二节 公司治理' || {_LF} || '正文' WHEN 2 THEN '一、概况' || {_LF} || '正文' || {_LF} || '二、治理' "
    f"WHEN 3 THEN '财务报告 7' || {_LF} || '审计报告.....9' || {_LF} || '公司治理 ' || {_S} || {_LF} || '关联交易 11' || {_LF} || '重大合同  13' || {_LF} || '说明' "
    f"WHEN 4 THEN '章节' || {_LF} || '应付债券 123.45 12' || {_LF} || '2024年度报告 目录 3' || {_LF} || '董事会会议次数 5' || {_LF} || '公司治理应当遵循的公开公平公正原则及其他 6' || {_LF} || '债券 5' "
    "ELSE '' END AS text FROM lines"
)
OUTLINES = "SELECT k AS doc_id, idx, 1 AS level, '书签' || idx AS title, CAST(idx * 3 AS INT) AS page FROM lines WHERE k % 4 = 0"
#: Spans of pages, from line items.
SPANS = f"""SELECT l_orderkey AS doc_id, CAST(l_linenumber % 2 AS INT) AS page, CASE l_partkey % 5 WHEN 0 THEN CAST(l_suppkey AS VARCHAR(9)) WHEN 1 THEN '目 录' WHEN 2 THEN '第一节 公司简介.....第二节 治理....第三节 其他...' WHEN 3 THEN '一、概况 （二）治理 3.1 其他 ... ···' ELSE 'x' END AS text,
 CAST(l_partkey % 5 * 100 + 120 AS DOUBLE) AS x0, CAST(l_linenumber * 9 AS DOUBLE) AS y0, CAST(l_partkey % 5 * 100 + 160 AS DOUBLE) AS x1, CAST(l_linenumber * 9 + 8 AS DOUBLE) AS y1, CAST(10 AS DOUBLE) AS size, CAST(l_suppkey % 32 AS INT) AS flags FROM lineitem"""
#: Printed lines of contents pages in three formats.
PRINTED = f"""SELECT k AS doc_id, 1 AS page, CAST(idx AS INT) AS line_no, CASE k % 3 WHEN 0 THEN '第' || substr('一二三四五六七', CAST(idx AS INT), 1) || '节 标题' || CASE WHEN s % 2 = 0 THEN '.....' ELSE ' ' END || {_S}
 WHEN 1 THEN CASE WHEN idx % 2 = 0 THEN '第一章 公司简介......' WHEN idx = 3 THEN '备查文件' ELSE '重要提示' END ELSE CASE idx % 3 WHEN 0 THEN {_S} WHEN 1 THEN '·····' ELSE 'Page ' || {_S} END END AS text FROM lines"""
