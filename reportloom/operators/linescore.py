"""Sections by scored lines: every line is tested and scored on its own, then each document's titles are picked in catalogue order."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scan import BLANKS, lists, remembered, small_batches, texts_of, translated
from ..functions.text import let, strip

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Sections in order, each with its aliases in order of trial. Names with a leading underscore only absorb lines.
ALIASES = {
    "重要提示_目录_释义": "重要提示 目录 释义 重要提示、目录和释义 重要提示、目录及释义 重要提示、目录 重要提示及释义",
    "公司简介和主要财务指标": "公司简介和主要财务指标 公司简介 公司基本情况 主要财务指标 主要会计数据和财务指标 公司基本情况和主要财务指标 公司基本情况及主要会计数据和财务指标",
    "管理层讨论与分析": "管理层讨论与分析 经营情况讨论与分析 董事会报告 报告期内公司所处行业情况 管理层分析与讨论 经营情况 公司业务概要",
    "公司治理": "公司治理 公司治理情况 治理情况 公司治理、环境和社会 公司治理、环境和社会责任 公司治理暨企业管治报告 公司治理及内部控制 公司治理、环境与社会责任",
    "环境和社会责任": "环境和社会责任 环境与社会责任 社会责任 环境保护相关情况 社会责任情况 环境、社会及公司治理 环境与公司治理 社会责任和公司治理 企业社会责任 ESG",
    "重要事项": "重要事项 重大事项 其他重要事项 重要事项及风险提示 重要事项说明",
    "股份变动及股东情况": "股份变动及股东情况 股份变动和股东情况 股东和实际控制人情况 股份变动、股东情况 普通股股份变动及股东情况 股本变动及股东情况 股东情况",
    "债券相关情况": "债券相关情况 公司债券相关情况 可转换公司债券相关情况 优先股相关情况 债券情况 公司债券 可转换债券",
    "财务报告": "财务报告 审计报告 财务报表 财务报表附注 审计报告及财务报表 财务会计报告 财务报告及审计报告 审计报告及财务报告",
    "_财务报告_审计报告": "审计报告 审计意见",
    "_财务报告_财务报表": "合并资产负债表 合并利润表 合并现金流量表 合并所有者权益变动表 资产负债表 利润表 现金流量表",
    "_财务报告_附注": "财务报表附注 附注",
}
# Words that make a short section of this name worth keeping.
SHORT_BUT_MEANT = {
    "债券相关情况": "不存在 无 未发行 没有 不适用 无相关 截至报告期末 报告期内 公司未 本公司未",
    "环境和社会责任": "环保 排放 碳 节能 减排 绿色 污染 废物 资源 可持续 社会责任 捐赠 公益 扶贫 乡村振兴",
    "重要事项": "诉讼 仲裁 担保 质押 冻结 处罚 违规 关联交易 收购 重组 合并",
}
_NUM = "[一二三四五六七八九十百零〇两]"
PREFIX = rf"(?U)^(?:第(?:{_NUM}+|\d+)[节章]|(?:{_NUM}+|\d+)[、.．\s]|\((?:{_NUM}+|\d+)\))"
PUNCTUATION = r"(?U)[\s　:：、，,。.．\-—_/\\（）()\[\]【】]+"
CONTENTS_SHARE, NEAR, LEAST = 0.18, 500, 200


def normalised(text: Column) -> Column:
    """Line ends, ideographic blanks and runs of blanks made one kind, at most two blank lines, page numbers glued to titles gone; one line end last."""
    steps = [(re.compile(p), r) for p, r in (("\r\n?", "\n"), ("[\t 　]+", " "), ("\n{4,}", "\n\n\n"), (translated("(?m)^[0-9]+(第[一二三四五六七八九十]+[节章])"), r"\1"))]

    @F.arrow_udf("string")
    def made(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts_of(texts):
            if t is not None:
                t = t.removeprefix("\ufeff")
                for p, r in steps:
                    t = p.sub(r, t)
                t = t.strip(BLANKS) + "\n"
            out.append(t)
        return pa.array(out, pa.string())

    return made.asNondeterministic()(text)


_PUNCTUATION, _PREFIX = re.compile(PUNCTUATION[4:].replace(r"\s", BLANKS)), re.compile(PREFIX[4:].replace(r"\s", BLANKS))
_NOISE = re.compile(rf"(?:[-_=—·.{BLANKS}]+|第?[{BLANKS}]*\d+[{BLANKS}]*页)\Z")
_LEADERS, _PAGE, _DIGITS = re.compile(rf"[.·•…]{{2,}}[{BLANKS}]*\d+\Z"), re.compile(rf"[{BLANKS}]\d{{1,4}}\Z"), re.compile(r"\d")


def compact(line: str) -> str:
    return _PUNCTUATION.sub("", line)


def is_noise(line: str) -> bool:
    return len(line) <= 1 or bool(_NOISE.match(line))


def is_contents(line: str) -> bool:
    return bool(_LEADERS.search(line) or _PREFIX.match(line) and _PAGE.search(line))


def is_title(line: str) -> bool:
    """A stripped line of at most 70 characters without punctuation, at most 35 % of them digits, that has a number in front or at most 24 characters."""
    if len(line) > 200 and len(compact(line[:200])) > 70:
        return False
    n = len(bare := compact(line))
    return n <= 70 and len(_DIGITS.findall(bare)) * 100 <= n * 35 and (n <= 24 or bool(_PREFIX.match(line)))


def _titles(known: list[tuple[int, str, str, str]]) -> Callable[[str], list]:
    """A function that gives a text's titles: (section_idx, canonical, alias, raw_title, line_no from 0, start, size of the line)."""

    def of_line(line: str) -> list:
        line = line.strip(BLANKS)
        if is_noise(line) or not is_title(line) or is_contents(line):
            return []
        bare = compact(line)
        return [(i, name, alias, line) for i, name, alias, word in known if word in bare][:1]

    named = remembered(of_line)

    def of_text(text: str) -> list:
        out, at = [], 0
        for k, line in enumerate(text.split("\n")):
            out += [(*x, k, at, len(line)) for x in named(line)]
            at += len(line) + 1
        return out

    return of_text


_HIT = "struct<section_idx:int,canonical:string,alias:string,raw_title:string,line_no:int,start:int,size:int>"
_ITEM = "struct<section_idx:int,start:int,line_no:int,canonical:string,raw_title:string,end:int,points:int,evidence:array<string>>"


def scored(text: Column, aliases: dict[str, str] = ALIASES) -> Column:
    """array of the title lines of a text in their order, with points and evidence."""
    known = [(i, name, a, compact(a)) for i, (name, words) in enumerate(aliases.items()) for a in words.split(" ")]

    @F.arrow_udf(f"array<{_HIT}>")
    def found(texts: pa.Array) -> pa.Array:
        titles = _titles(known)
        per = [titles(t) if t else [] for t in texts_of(texts)]
        flat = [x for items in per for x in items]
        kinds = {"section_idx": pa.int32(), "canonical": pa.string(), "alias": pa.string(), "raw_title": pa.string(), "line_no": pa.int32(), "start": pa.int32(), "size": pa.int32()}
        return lists([len(items) for items in per], {name: pa.array([x[i] for x in flat], kind) for i, (name, kind) in enumerate(kinds.items())})

    def item(x: Column) -> Column:
        t = x["raw_title"]
        numbered, late, short = t.rlike(PREFIX), x["start"] > F.floor(F.length(text) * CONTENTS_SHARE), F.length(t) <= 40
        points = 550 + F.when(numbered, 250).otherwise(0) + F.when(late, 100).otherwise(-100) + F.when(short, 50).otherwise(0)
        why = F.array_compact(F.array(
            F.concat(F.lit("alias:"), x["alias"]), F.when(numbered, F.lit("section_prefix")),
            F.when(late, "outside_toc_region").otherwise("early_document_region"), F.when(short, F.lit("short_heading")),
        ))
        return F.struct(
            x["section_idx"].alias("section_idx"), x["start"].alias("start"), (x["line_no"] + 1).alias("line_no"), x["canonical"].alias("canonical"), t.alias("raw_title"),
            (x["start"] + x["size"] + 1).alias("end"), points.alias("points"), why.alias("evidence"),
        )

    return F.transform(found.asNondeterministic()(text), item)


def scored_lines(docs: DataFrame, aliases: dict[str, str] = ALIASES) -> DataFrame:
    """(doc_id, section_idx, canonical, raw_title, line_no, start, end, points, evidence) of docs (doc_id, text), one row for each title line.

    The first alias in catalogue order that the line holds names its section. Points are thousandths: 550, 250 more
    for a number in front, 100 more or fewer after or in the first 18 % of the text, 50 more for at most 40 characters.
    A null or empty text has no titles. Everything is decided within the row of a text: nothing is shuffled.
    """
    small_batches(docs.sparkSession)
    x = docs.select("doc_id", F.explode(scored(F.col("text"), aliases)).alias("x"))
    return x.select("doc_id", *[f"x.{f}" for f in ("section_idx", "canonical", "raw_title", "line_no", "start", "end", "points", "evidence")])


def picked(items: Column, near: int = NEAR) -> Column:
    """Of an array of title lines at most one for each section, as ``pick`` has it; null without any."""
    kind = f"array<{_ITEM}>"
    none = F.array().cast(kind)
    same = lambda acc, c: F.element_at(acc, -1)["section_idx"] == c["section_idx"]
    add = lambda acc, c: F.concat(acc, F.array(c.cast(kind[6:-1])))
    own = F.array_sort(F.filter(items, lambda x: ~x["canonical"].startswith("_")))
    apart = F.aggregate(own, none, lambda acc, c: F.when((F.size(acc) > 0) & same(acc, c) & (c["start"] - F.element_at(acc, -1)["start"] < near), acc).otherwise(add(acc, c)))
    return F.aggregate(apart, none, lambda acc, c: F.when((F.size(acc) > 0) & (same(acc, c) | (c["start"] <= F.element_at(acc, -1)["start"])), acc).otherwise(add(acc, c)))


def pick(found: DataFrame, near: int = NEAR) -> DataFrame:
    """Of ``found`` at most one title for each section: titles of a section nearer than ``near`` to the last one kept go,
    then each section in catalogue order takes its first title behind the one taken before."""
    item = F.struct("section_idx", "start", "line_no", "canonical", "raw_title", "end", "points", "evidence")
    rows = found.filter(~F.col("canonical").startswith("_")).groupBy("doc_id").agg(F.collect_list(item).alias("items"))
    return rows.select("doc_id", F.explode(picked(F.col("items"), near)).alias("x")).select("doc_id", "x.*")


def is_meant(text: Column, section: Column) -> Column:
    """Whether a short section says something: words of its own list, or a line of over 20 characters behind its title."""
    t = strip(text)
    said = F.coalesce(*[F.when(section == s, F.exists(F.array(*[F.lit(w) for w in words.split(" ")]), lambda w: F.contains(F.lower(t), w))) for s, words in SHORT_BUT_MEANT.items()], F.lit(False))
    lines = F.filter(F.transform(F.split(t, "\n", -1), strip), lambda x: x != "")
    body = F.exists(F.slice(lines, 2, 2**31 - 1), lambda x: (F.length(x) > 20) & ~x.rlike(PREFIX))
    return (F.length(t) >= 10) & (said | body)


def sections(docs: DataFrame, aliases: dict[str, str] = ALIASES, least: int = LEAST) -> DataFrame:
    """(doc_id, section_id, ord, canonical, raw_title, start, end, start_line, end_line, n_chars, points, status) for every document and section.

    A section ends where the next picked title starts; status is matched, too_short or missing (no title: null span).
    """
    small_batches(docs.sparkSession)
    text = F.col("text")
    n_lines = F.size(F.split(text, "\n", -1)) - F.when(text.endswith("\n"), 1).otherwise(0)

    def closed(ps: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            then = F.get(ps, i + 1)
            stop = F.coalesce(then["start"], F.length(text))
            content = F.substring(text, x["start"] + 1, stop - x["start"])
            status = F.when((stop - x["start"] >= least) | is_meant(content, x["canonical"]), "matched").otherwise("too_short")
            return F.struct(
                x["section_idx"].alias("section_idx"), x["raw_title"].alias("raw_title"), x["start"].alias("start"), stop.alias("end"), x["line_no"].alias("start_line"),
                F.coalesce(then["line_no"], n_lines).alias("end_line"), x["points"].alias("points"), status.alias("status"),
            )

        return F.transform(ps, one)

    names = F.array(*[F.lit(n) for n in aliases if not n.startswith("_")])
    ready = docs.select("doc_id", let(picked(scored(text, aliases)), closed).alias("ready"))
    frame = ready.select("doc_id", "ready", F.posexplode(names).alias("section_idx", "canonical"))
    own = F.get(F.filter("ready", lambda x: x["section_idx"] == F.col("section_idx")), F.lit(0))
    full = frame.select("doc_id", "section_idx", "canonical", F.struct(own.alias("x")).alias("x")).select("doc_id", "section_idx", "canonical", *[F.col(f"x.x.{f}").alias(f) for f in ("raw_title", "start", "end", "start_line", "end_line", "points", "status")])
    ord_ = F.col("section_idx") + 1
    return full.select(
        "doc_id", F.concat(F.lit("sec_"), F.lpad(ord_.cast("string"), 2, "0")).alias("section_id"), ord_.alias("ord"), "canonical", "raw_title", "start", "end", "start_line", "end_line",
        F.coalesce(F.col("end") - F.col("start"), F.lit(0)).alias("n_chars"), F.coalesce("points", F.lit(0)).alias("points"), F.coalesce("status", F.lit("missing")).alias("status"),
    )
