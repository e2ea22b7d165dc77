"""Value tiers, report type, note tiers and quality status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let

# Tiers with their sections and keywords, in order of preference.
TIERS = {
    "strong": ("公司简介和主要财务指标 财务报告", "财务指标 营业收入 净利润 总资产 净资产 资产负债表 利润表 现金流量表 股东 分红 派息"),
    "semi": ("管理层讨论与分析 重要事项", "经营情况 主营业务 行业分析 竞争格局 风险因素 重大事项 诉讼 仲裁 担保 环保 处罚 关联交易"),
    "weak": ("公司治理 环境和社会责任 股份变动及股东情况 债券相关情况", "董事 监事 高管 会议 制度 环保措施 社会责任 捐赠 公益 股份变动 股东 债券"),
    "low": ("重要提示_目录_释义", "重要提示 目录 释义 备查文件 免责声明 审计意见"),
}
# What tells a summary of a report.
TITLES = (r"年度报告摘要", r"年报摘要", r"(?m)^\s*摘要\s*$")
HINTS = (r"本摘要来自年度报告全文", r"为全面了解本公司的经营成果", r"年度报告摘要已刊登于", r"投资者欲了解详细内容", r"应当仔细阅读同时刊载于", r"以上.*?摘自.*?年度报告", r"本公司董事会保证本摘要", r"详见.*年度报告全文")
SUMMARY_SECTIONS = (r"(?:^|\n)\s*公司经营情况\s*(?:\n|$)", r"(?:^|\n)\s*主要会计数据\s*(?:\n|$)", r"(?:^|\n)\s*主要财务指标\s*(?:\n|$)", r"(?:^|\n)\s*(?:三|3)\.\d+\s*主要会计数据")


def votes(content: Column, words: str) -> Column:
    return F.size(F.filter(F.array(*[F.lit(w) for w in words.split()]), lambda k: F.contains(content, k)))


#: Characters that a section of each tier has at least, when nothing else tells it.
LEAST = {"strong": 1000, "semi": 500, "weak": 50, "low": 0}
# The value of standard sections in the two pipelines; they differ.
VALUES = {
    "report": {"管理层讨论与分析": "HIGH", "财务报告": "HIGH", "重要事项": "MEDIUM", "公司治理": "MEDIUM", "股份变动及股东情况": "MEDIUM", "环境和社会责任": "LOW", "债券相关情况": "LOW", "重要提示_目录_释义": "LOW", "公司简介和主要财务指标": "LOW", "_PREAMBLE": "UNMAPPED"},
    "lossless": {"管理层讨论与分析": "HIGH", "财务报告": "HIGH", "财务报表附注": "HIGH", "重要事项": "MEDIUM", "公司治理": "MEDIUM", "股份变动及股东情况": "MEDIUM", "债券相关情况": "MEDIUM", "公司简介和主要财务指标": "LOW", "重要提示_目录_释义": "LOW", "环境和社会责任": "LOW"},
}


def mapped_value(name: Column, pipeline: str = "report") -> Column:
    """A standard section's value; UNMAPPED for other names."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in VALUES[pipeline].items() for x in kv]), name), F.lit("UNMAPPED"))


def value_tier(sections: DataFrame, tiers: dict[str, tuple[str, str]] = TIERS) -> DataFrame:
    """(doc_id, canonical, tier, votes, score, evidence): by the section's name, else by most keywords (the first tier of equals), else by length.

    score is the section's confidence (column confidence, else 1), four fifths of it for fewer than 200 characters, and a tenth more, up to 1, if a keyword of the tier occurs.
    """
    name, n = F.col("canonical"), F.length("content")
    s = sections if "confidence" in sections.columns else sections.withColumn("confidence", F.lit(1.0))
    # a tier by name needs no votes, so they are counted for the others alone if nothing but the tier is asked for
    counted = F.array(*[votes(F.col("content"), words) for _, words in tiers.values()])
    by_name = F.coalesce(*[F.when(name.isin(*names.split()), F.lit(t)) for t, (names, _) in tiers.items()])
    most = lambda v: F.when(F.array_max(v) > 0, F.get(F.array(*[F.lit(t) for t in tiers]), F.array_position(v, F.array_max(v)).cast("int") - 1))
    by_length = F.coalesce(*[F.when(n >= least, F.lit(t)) for t, least in LEAST.items()])
    s = s.withColumns({"tier": F.coalesce(by_name, let(counted, most), by_length), "_votes": counted})
    best = F.array_max("_votes")
    at = lambda t: F.get("_votes", F.lit(list(tiers).index(t)))
    own = F.coalesce(*[F.when(F.col("tier") == t, at(t)) for t in tiers])
    plain = F.when(n < 200, F.col("confidence") * 0.8).otherwise(F.col("confidence"))
    evidence = F.when(by_name.isNotNull(), F.concat(F.lit("section_name:"), by_name)).when(best > 0, F.concat(F.lit("keywords:"), best.cast("string"))).otherwise(F.concat(F.lit("length:"), n.cast("string")))
    return s.select("doc_id", "canonical", "tier", best.cast("long").alias("votes"), F.round(F.when(own > 0, F.least(plain + 0.1, F.lit(1.0))).otherwise(plain), 2).alias("score"), evidence.alias("evidence"))


def labelled(sections: DataFrame, found: DataFrame) -> DataFrame:
    """Value labels of standard sections ``found`` (doc_id, canonical, confidence, status) with the texts of ``sections`` (doc_id, canonical, content); one without a text counts as empty."""
    both = found.join(sections.select("doc_id", "canonical", "content"), ["doc_id", "canonical"], "left").withColumn("content", F.coalesce("content", F.lit("")))
    return value_tier(both).join(found.select("doc_id", "canonical", "status"), ["doc_id", "canonical"])


def tier_summary(labels: DataFrame) -> DataFrame:
    """(doc_id, total, strong, semi, weak, low, strong_ratio): counts of tiers, and the strong ones in per cent."""
    counts = [F.count_if(F.col("tier") == t).alias(t) for t in TIERS]
    return labels.groupBy("doc_id").agg(F.count("*").alias("total"), *counts).withColumn("strong_ratio", F.round(F.col("strong") * 100 / F.col("total"), 1))


def of_tier(labels: DataFrame, tier: str) -> DataFrame:
    return labels.filter(F.col("tier") == tier)


def report_type(docs: DataFrame) -> DataFrame:
    """(doc_id, points, doc_type): 60 for a summary's title in 3000 characters, 25 for a hint, 10 for a section in 20000, 15 for few pages; 50 or more is a summary, 0 a report."""
    t = F.coalesce("text", F.lit(""))
    head, wide = F.substring(t, 1, 3000), F.substring(t, 1, 20000)
    some = lambda c, ps: F.when(F.coalesce(*[F.when(c.rlike(p), F.lit(True)) for p in ps], F.lit(False)), 1).otherwise(0)
    pages = F.greatest(F.lit(1), F.expr("length(coalesce(text, '')) div 1500"))
    points = some(head, TITLES) * 60 + some(wide, [f"(?i){h}" for h in HINTS]) * 25 + some(wide, SUMMARY_SECTIONS) * 10 + F.when((pages <= 30) & head.contains("摘要"), 15).otherwise(0)
    points = F.least(points, F.lit(100))
    return docs.select("doc_id", points.cast("long").alias("points"), F.when(points >= 50, "summary").when(points > 0, "unknown").otherwise("annual_report").alias("doc_type"))


def from_name(name: Column) -> Column:
    """struct<points, doc_type> of a document of which only the file's name is known: 30 and unknown for a summary's name."""
    short = name.contains("摘要")
    return F.struct(F.when(short, 30).otherwise(0).alias("points"), F.when(short, "unknown").otherwise("annual_report").alias("doc_type"))


def qa_status(docs: DataFrame) -> DataFrame:
    n = F.length(F.coalesce("text", F.lit("")))
    return docs.select("doc_id", F.when(n < 1000, "fail").when(n < 5000, "warning").otherwise("pass").alias("qa"))
