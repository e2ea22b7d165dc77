"""Deep splits of financial reports: anchors in order, notes with tiers, tables by their evidence, titles placed by look-ahead."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scan import all_places, hits, small_batches
from ..functions.text import let, strip
from .split import matches

# Statements in their order, words of risky notes, words of notes that the second split keeps, signs of a table.
STATEMENTS = ("审计报告", "合并资产负债表", "合并利润表", "合并现金流量表", "合并所有者权益变动表", "财务报表附注")
ALL_STATEMENTS = (
    "审计报告", "合并资产负债表", "母公司资产负债表", "合并利润表", "母公司利润表", "合并现金流量表", "母公司现金流量表", "合并所有者权益变动表", "母公司所有者权益变动表", "财务报表附注",
)
RISKY = ("关联方", "关联交易", "或有事项", "承诺", "日后事项", "风险", "诉讼")
KEY_NOTES = ("存货", "收入", "关联交易", "应收", "应付", "金融工具", "公允价值")
TABLE_SIGNS = ("编制单位", "项目", "期末余额", "本期发生", "流动资产", "货币资金")
ISSUER = "编制单位"
# Sub-sections with their aliases.
STATEMENT_ALIASES = {
    "审计报告": "审计报告 审计意见", "合并资产负债表": "合并资产负债表", "合并利润表": "合并利润表", "合并现金流量表": "合并现金流量表",
    "合并所有者权益变动表": "合并所有者权益变动表 合并股东权益变动表", "财务报表附注": "财务报表附注 合并财务报表附注",
}
DISCUSSION_ALIASES = {
    "主营业务": "报告期内公司从事的主要业务 公司的主营业务 主要业务 公司从事的主要业务 主营业务情况", "行业分析": "报告期内公司所处行业情况 行业情况 所处行业 行业分析 行业概况 行业现状",
    "经营情况": "经营情况讨论与分析 主要经营情况 经营情况分析 报告期内经营情况 经营成果", "风险因素": "可能面对的风险 公司面临的风险 风险因素 主要风险 风险提示 风险分析",
    "未来战略": "公司未来发展的展望 未来发展战略 公司发展战略 发展展望 未来规划 战略规划",
}
NOTE_ALIASES = {
    "关联交易": "十、关联方 十、关联交易 关联方及关联交易 十一、关联方 关联方关系", "或有事项": "十二、或有事项 十一、或有事项 承诺及或有事项 十三、或有事项 预计负债",
    "资产负债表日后事项": "十三、资产负债表日后事项 十二、资产负债表日后事项 十四、资产负债表日后事项 期后事项",
    "其他重要事项": "十四、其他重要事项 十三、其他重要事项 十五、其他重要事项 其他重大事项 十六、其他重要事项 分部报告",
}
_NUM = "[一二三四五六七八九十]+"


def _any(c: Column, words: tuple[str, ...]) -> Column:
    return c.rlike("|".join(words))


def note_tier(title: Column) -> Column:
    return F.when(_any(title, RISKY), "HIGH_RISK_NOTES").otherwise("HIGH_FINANCIALS")


def places(text: Column, part: Column) -> Column:
    """array<int> of the offsets where ``part`` occurs in ``text``, not overlapping."""
    gaps = F.split(text, F.concat(F.lit(r"\Q"), part, F.lit(r"\E")), -1)
    upto = F.transform(F.slice(gaps, F.lit(1), F.greatest(F.size(gaps) - 1, F.lit(0))), lambda x: F.length(x))
    return F.transform(upto, lambda n, i: F.aggregate(F.slice(upto, F.lit(1), i + 1), F.lit(0), lambda a, x: a + x) + i * F.length(part))


def closed(points: DataFrame, docs: DataFrame, lead_title: str) -> DataFrame:
    """points (doc_id, pos, rank, title) as blocks up to the next point, text before the first under ``lead_title``; docs: doc_id, text. Empty blocks go."""
    w = Window.partitionBy("doc_id").orderBy("pos", "rank", "title")
    first = docs.join(points.groupBy("doc_id").agg(F.min("pos").alias("first")), "doc_id", "left").select("doc_id", F.lit(0).alias("pos"), F.lit(-1).alias("rank"), F.lit(lead_title).alias("title"))
    both = points.select("doc_id", "pos", "rank", "title").unionByName(first)
    ends = both.withColumn("next", F.lead("pos").over(w)).join(docs, "doc_id")
    return ends.select("doc_id", "rank", "title", F.col("pos").alias("start"), F.coalesce("next", F.length("text")).alias("end"), "text").filter("end > start")


def deep_split(docs: DataFrame) -> DataFrame:
    """(doc_id, sub_idx, title, start, end, tier) of financial reports (doc_id, text); blocks cover the whole text.

    Each statement is sought behind the one found before it; behind the notes' title every line with a Chinese number
    is a note with its own tier. A null or empty text has no block.
    """
    d = docs.select("doc_id", "text")
    steps = ", ".join(f"'{s}'" for s in STATEMENTS)
    fold = F.expr(
        f"""aggregate(array({steps}), named_struct('at', 1, 'found', cast(array() as array<struct<pos:int,title:string>>)),
        (acc, s) -> CASE WHEN locate(s, text, acc.at) > 0
          THEN named_struct('at', locate(s, text, acc.at) + length(s), 'found', concat(acc.found, array(named_struct('pos', locate(s, text, acc.at) - 1, 'title', s)))) ELSE acc END, acc -> acc.found)"""
    )
    main = d.withColumn("found", fold)
    notes_at = F.element_at(F.filter("found", lambda x: x["title"] == STATEMENTS[-1]), 1)["pos"]
    own = main.select("doc_id", F.explode("found").alias("f")).select("doc_id", "f.pos", F.lit(0).alias("rank"), "f.title")
    tail = main.filter(F.exists("found", lambda x: x["title"] == STATEMENTS[-1])).withColumn("at", notes_at).withColumn("tail", F.substring(F.col("text"), F.col("at") + 1, F.length("text")))
    note = rf"(?U)\n{_NUM}、\s*[^。\n]{{2,30}}(?=\n|$)"
    notes = tail.select("doc_id", "at", F.explode(matches(F.col("tail"), F.lit(note))).alias("m")).select("doc_id", (F.col("at") + F.col("m.at") + 1).alias("pos"), F.lit(1).alias("rank"), strip(F.col("m.hit")).alias("title"))
    blocks = closed(own.unionByName(notes), d, "财务报告_前言")
    w = Window.partitionBy("doc_id").orderBy("start")
    name = F.regexp_replace("title", rf"(?U)^{_NUM}、\s*", "")
    tier = F.when(F.col("rank") < 0, "MEDIUM").when(F.col("rank") == 1, note_tier(name)).otherwise("HIGH_FINANCIALS")
    return blocks.select("doc_id", (F.row_number().over(w) - 1).alias("sub_idx"), "title", "start", "end", tier.alias("tier"))


def deep_split_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, sub_idx, title, start, end, tier): blocks at lines that are nothing but a statement's title (all of them, consolidated or not) and at key notes. A block bears its own title; a text without any is one block."""
    d = docs.select("doc_id", "text")
    kinds = [(k, s, rf"(?U)(?:^|\n)\s*{s}\s*\n") for k, s in enumerate(ALL_STATEMENTS)] + [(len(ALL_STATEMENTS), None, rf"(?U)(?:^|\n)\s*{_NUM}、\s*[^\n]{{2,30}}\s*\n")]
    small_batches(docs.sparkSession)
    found = hits(F.col("text"), [(s or "、", p) for _, s, p in kinds])
    rows = d.select("doc_id", F.explode(found).alias("m"))
    hits_ = rows.select("doc_id", F.col("m.k").alias("rank"), F.get(F.array(*[F.lit(s) for _, s, _ in kinds]), F.col("m.k")).alias("name"), "m")
    title = F.coalesce("name", F.concat(F.lit("附注_"), strip(F.col("m.hit"))))
    found = hits_.select("doc_id", F.col("m.at").alias("pos"), "rank", title.alias("title")).filter(F.col("name").isNotNull() | _any(F.col("title"), KEY_NOTES)).distinct()
    blocks = closed(found, d, "财务报告_前言")
    alone = (F.col("rank") < 0) & (F.count("*").over(Window.partitionBy("doc_id")) == 1)
    named = blocks.withColumn("title", F.when(alone, "财务报告_未细分").otherwise(F.col("title")))
    w = Window.partitionBy("doc_id").orderBy("start")
    return named.select("doc_id", (F.row_number().over(w) - 1).alias("sub_idx"), "title", "start", "end", F.when(F.col("title").contains("附注"), "HIGH").otherwise("MEDIUM").alias("tier"))


def with_tables(subs: DataFrame, docs: DataFrame, exempt: str = "审计报告", reach: int = 300) -> DataFrame:
    """subs (doc_id, sub, start, end) whose first ``reach`` characters show signs of a table (or that are ``exempt``), closed anew; docs: doc_id, text."""
    j = subs.select("doc_id", "sub", "start").join(docs.select("doc_id", "text"), "doc_id")
    shown = (F.col("sub") == exempt) | _any(F.substring(F.col("text"), F.col("start") + 1, F.lit(reach)), TABLE_SIGNS)
    w = Window.partitionBy("doc_id").orderBy("start", "sub")
    return j.filter(shown).select("doc_id", "sub", "start", F.coalesce(F.lead("start").over(w), F.length("text")).alias("end"))


def issuer_parts(text: Column) -> Column:
    """array<struct<sub,start,end>>: statements by every second mention of the issuer's line, for texts with at least four; what isn't there ends with the text."""

    def parts(p: Column) -> Column:
        bounds = [F.lit(0), *[F.get(p, F.lit(k)) for k in (0, 2, 4, 6, 8)]]
        each = [F.struct(F.lit(s).alias("sub"), b.alias("start"), F.coalesce(bounds[k + 1] if k < 5 else F.lit(None), F.length(text)).alias("end")) for k, (s, b) in enumerate(zip(STATEMENTS, bounds))]
        return F.when(F.size(p) >= 4, F.filter(F.array(*each), lambda x: x["start"].isNotNull()))

    return let(places(text, F.lit(ISSUER)), parts)


def by_issuer(docs: DataFrame) -> DataFrame:
    """(doc_id, sub, start, end) of ``issuer_parts`` of each document."""
    return docs.select("doc_id", F.explode(issuer_parts(F.col("text"))).alias("s")).select("doc_id", "s.*")


def statements(docs: DataFrame, subs: DataFrame) -> DataFrame:
    """Sub-sections with tables, or the issuer's mentions for documents where at most one is left."""
    kept = with_tables(subs, docs).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("sub", "start", "end"))).alias("kept"))
    both = docs.select("doc_id", "text").join(kept, "doc_id", "left")
    chosen = F.when(F.size("kept") > 1, F.col("kept")).otherwise(F.coalesce(issuer_parts(F.col("text")), "kept"))
    return both.select("doc_id", F.explode(chosen).alias("s")).select("doc_id", "s.*")


def place_titles(docs: DataFrame, gap: int = 300) -> DataFrame:
    """(doc_id, idx, title, pos) for docs (doc_id, text, titles array<string>): the places of titles known in order.

    A place counts if the next title doesn't follow within ``gap`` characters (then both are in a contents page or a
    sentence); the next title is sought behind it. Titles without a place are left out, empty ones have none.
    """
    small_batches(docs.sparkSession)
    occ = all_places(F.col("text"), F.col("titles"))
    d = docs.select("doc_id", "text", F.col("titles").alias("titles")).filter("text IS NOT NULL AND titles IS NOT NULL").withColumn("occ", occ)
    # a fold over the titles' numbers: the cursor moves behind each place taken, or behind all tried ones
    fold = F.expr(
        f"""aggregate(sequence(0, size(titles) - 1), named_struct('at', 0, 'found', cast(array() as array<struct<idx:int,pos:int>>)), (acc, i) ->
        CASE WHEN exists(occ[i], p -> p >= acc.at AND NOT exists(coalesce(get(occ, i + 1), array()), q -> q >= p + length(titles[i]) AND q - p < {gap}))
          THEN named_struct('at', array_min(filter(occ[i], p -> p >= acc.at AND NOT exists(coalesce(get(occ, i + 1), array()), q -> q >= p + length(titles[i]) AND q - p < {gap}))) + length(titles[i]),
            'found', concat(acc.found, array(named_struct('idx', i, 'pos', array_min(filter(occ[i], p -> p >= acc.at AND NOT exists(coalesce(get(occ, i + 1), array()), q -> q >= p + length(titles[i]) AND q - p < {gap})))))))
          WHEN exists(occ[i], p -> p >= acc.at) THEN named_struct('at', array_max(occ[i]) + length(titles[i]), 'found', acc.found) ELSE acc END, acc -> acc.found)"""
    )
    return d.filter("size(titles) > 0").select("doc_id", "titles", F.explode(fold).alias("f")).select("doc_id", "f.idx", F.get("titles", F.col("f.idx")).alias("title"), "f.pos")
