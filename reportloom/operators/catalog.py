"""The section catalogue as data: names, order, aliases of three tiers and their patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Section names with their aliases, in order of trial.
SECTIONS = {
    "公司简介和主要财务指标": "公司简介和主要财务指标 公司基本情况简介 公司簡介和主要財務指標 公司簡介 公司資料 公司简介 关于我们 關於我們",
    "管理层讨论与分析": "管理层讨论与分析 管理層討論與分析 管理概览 管理層概覽 经营情况讨论与分析 經營情況討論與分析 经营情况概览 業務回顧 主席致辞 董事長致辭",
    "公司治理、环境和社会": "公司治理、环境和社会 公司治理环境和社会 公司治理 企業管治 企業管治報告 环境、社会及公司治理",
    "重要事项": "重要事项 重要事項 董事會報告 董事会报告",
    "股份变动及股东情况": "股份变动及股东情况 股份变动及股东 股本变动及重要股东情况 股本變動及重要股東情況 股東情況 股东情况",
    "债券相关情况": "债券相关情况 债券相关 債券相關情況 債券相關",
    "财务报告": "财务报告 財務報告 財務報表 财务报表 审计报告及财务报告 審計報告及財務報告 獨立核數師報告",
    "审计报告": "审计报告 審計報告 獨立核數師報告",
    "关联方及关联交易": "关联方及关联交易 關聯方及關聯交易 關聯方關係及交易 关联方关系及交易 关联方及其交易 關聯方及其交易",
    "重要交易和事项": "重要交易和事项 重要交易和事項",
    "重要提示、目录和释义": "重要提示、目录和释义 重要提示、目錄和釋義 重要提示",
}
# Aliases that only fill sections still missing.
FALLBACK = {
    "审计报告": "审计意见 关键审计事项 注册会计师的责任 管理层和治理层对财务报表的责任 獨立核數師報告",
    "公司基本情况": "公司的基本情况 本公司的基本情况 公司概况 公司概況",
    "关联方及关联交易": "关联方关系及其交易 关联方关系及交易 关联方及其交易 关联交易 關聯方關係及其交易",
    "重要交易和事项": "重要承诺事项 或有事项 资产负债表日后事项 其他重要事项",
}
# The order band of each section.
ORDER = {
    "前言及重要提示": 10, "重要提示、目录和释义": 20, "公司简介和主要财务指标": 30, "管理层讨论与分析": 40, "公司治理、环境和社会": 50, "重要事项": 60,
    "股份变动及股东情况": 70, "债券相关情况": 80, "财务报告": 90, "审计报告": 90, "公司基本情况": 999, "关联方及关联交易": 110, "重要交易和事项": 120,
}
# Numbered standard sections, those a report must have, those it may lack.
STANDARD = (
    ("010", "前言及重要提示"), ("020", "重要提示、目录和释义"), ("030", "公司简介和主要财务指标"), ("040", "管理层讨论与分析"), ("050", "公司治理、环境和社会"), ("060", "重要事项"),
    ("070", "股份变动及股东情况"), ("080", "债券相关情况"), ("090", "财务报告"), ("100", "审计报告"), ("110", "关联方及关联交易"), ("120", "重要交易和事项"),
)
CORE = ("030", "040", "090")
OPTIONAL = ("080", "100", "110", "120")
ANCHORS = ("公司简介和主要财务指标", "管理层讨论与分析", "公司治理、环境和社会", "重要事项", "财务报告")
NUMBERING = r"(?:第[一二三四五六七八九十0-9]+(?:节|章)|[（(][一二三四五六七八九十0-9]+[)）]|[一二三四五六七八九十0-9]+[、.．])"
PAGE_HEADER = r"年度报告|半年度报告|季度报告|股份有限公司|\d{4}年(?:度)?(?:报|报告)|季报|半年报"
HAN = "[一-龥]"


def body(alias: str) -> str:
    """An alias with blanks allowed between its characters."""
    return r"[ \t]*".join(f"\\{c}" if c in r".^$*+?{}[]\|()" else c for c in alias)


def pattern(alias: str, tier: int) -> str:
    lead = {1: f"(?:{NUMBERING}[ \\t]*)", 2: "", 3: f"(?:{NUMBERING}[ \\t]*)?"}[tier]
    return f"(?<!{HAN}){lead}{body(alias)}(?!{HAN})"


def section_catalog(spark: SparkSession) -> DataFrame:
    """One row for each alias and tier: 1 numbered title, 2 bare title, 3 fallback. Its size is fixed by the catalogue."""
    rows = []
    for s, (name, aliases) in enumerate(SECTIONS.items()):
        for a, alias in enumerate(aliases.split(" ")):
            rows += [(s, name, ORDER[name], a, alias, tier, pattern(alias, tier)) for tier in (1, 2)]
    for name, aliases in FALLBACK.items():
        if name in SECTIONS:
            rows += [(list(SECTIONS).index(name), name, ORDER[name], a, alias, 3, pattern(alias, 3)) for a, alias in enumerate(aliases.split(" "))]
    return spark.createDataFrame(rows, "section_idx int, canonical string, ord int, alias_idx int, alias string, tier int, regex string")


def tree(words: set[str]) -> str:
    """A pattern for the words as a tree of their letters, blanks allowed between; longer words whose beginning is a word add nothing to a test."""
    if "" in words:
        return ""
    by = {}
    for w in sorted(words):
        by.setdefault(w[0], set()).add(w[1:])
    parts = [c + (r"[ \t]*" + tree(rest) if "" not in rest else "") for c, rest in by.items()]
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


def standard_sections(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n, name, n in CORE, n in OPTIONAL) for n, name in STANDARD], "number string, name string, is_core boolean, is_optional boolean")
