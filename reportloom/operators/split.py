"""Section boundaries: lines, candidates, contents skipping, ordered selection and spans.

Every text is one row from its gate to its spans, so nothing is shuffled (doc_id is unique): its lines with an alias are
tested in Python and give an array of candidates, few by the caps for each section; contents skipping, selection, merging
and cutting are expressions on it.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scan import BLANKS, lists, remembered, small_batches, texts_of, verdict
from ..functions.text import let
from . import catalog

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LOW_TEXT = 500
WEAK_CAP, FALLBACK_CAP, ANCHOR_OFFSET, EARLY = 20, 10, 200, 1000


SOURCES = {1: "strong", 2: "weak", 3: "fallback"}


def quality_gate(docs: DataFrame) -> DataFrame:
    """docs with status and reason: a summary in the first 30 lines, then empty, short, undecoded or hardly Chinese texts."""

    small_batches(docs.sparkSession)
    v = F.col("_gate")
    status = F.when(v == "summary", "ignored_summary").when(v != "", "ignored_low_quality").otherwise("accepted")
    gated = docs.withColumn("_gate", verdict(F.col("text"), LOW_TEXT))
    return gated.withColumns({"status": status, "reason": F.when((v != "") & (v != "summary"), v)}).drop("_gate")


def line_index(docs: DataFrame, *more: Column, keep: Column | None = None) -> DataFrame:
    """(doc_id, more, line_no, start, line): every line with its code-point offset, a running sum over the document's lines.

    With ``keep``, a condition on the column line, only lines that meet it are given, and no other text is shuffled.
    """
    each = docs.select("doc_id", *more, F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")).withColumn("size", F.length("line") + 1)
    if keep is not None:
        each = each.withColumn("line", F.when(keep, F.col("line")))
    before = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    out = each.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)).cast("int")).drop("size")
    out = out.select(*[c for c in out.columns if c not in ("line_no", "start", "line")], "line_no", "start", "line")
    return out if keep is None else out.filter("line IS NOT NULL")


def matches(line: Column, regex: Column) -> Column:
    """array<struct<at, hit>> of all matches: texts between them and the matches themselves add up to positions."""
    hits = F.regexp_extract_all(line, regex, F.lit(0))
    gaps = F.split(line, regex, -1)
    upto = F.transform(hits, lambda h, i: F.aggregate(F.slice(gaps, F.lit(1), i + 1), F.lit(0), lambda a, x: a + F.length(x)) + F.aggregate(F.slice(hits, F.lit(1), i), F.lit(0), lambda a, x: a + F.length(x)))
    return F.arrays_zip(upto.alias("at"), hits.alias("hit"))


_CITED, _QUOTED = re.compile("详见|参见|请参阅|参考|阅读|查阅"), re.compile('["“”]')
_HEADER, _NUMBERED = re.compile(catalog.PAGE_HEADER, re.A), re.compile(rf"^(?:{catalog.NUMBERING}|\d+\s*[、.．])?\Z", re.A)
_NUMBERING, _HAN = re.compile(catalog.NUMBERING), re.compile(catalog.HAN + "{3,}")
_PAGE, _LEAD = re.compile(rf"[{BLANKS}]{{5,}}\d+\Z"), re.compile(rf"\d+[{BLANKS}]+")


def likely_heading(raw: str, at: int, end: int) -> bool:
    """Whether a match in a line is a title. Offsets count in the raw line but cut the stripped one, as the behaviour to match has it."""
    line = raw.strip(BLANKS)
    after, before, hit = line[end:], line[:at].strip(BLANKS), line[at:end]
    if not line or sum(map(after.count, ".．…·")) > 5 or line.count("/") >= 2 or line.count("-") >= 3 or line.count("—") >= 2:
        return False
    if re.fullmatch(r"\d+", after.strip(BLANKS)) or _PAGE.search(line) or _LEAD.match(line) or _CITED.search(before) or _QUOTED.search(before):
        return False
    if _NUMBERING.search(hit):
        return True
    header = _HEADER.search(before)
    if before and not header and not _NUMBERED.search(before) and len(before) <= 20 and _HAN.search(before):
        return False
    return (end - at) / len(line) >= (0.1 if header else 0.25)


CAPS = {2: WEAK_CAP, 3: FALLBACK_CAP}
_FIELDS = ("section_idx", "canonical", "ord", "alias_idx", "alias", "tier", "regex")
_ITEM = "struct<tier:int,start:int,neg:int,section_idx:int,alias_idx:int,end:int,canonical:string,ord:int,alias:string,line_text:string,reason:string>"


def _search(rows: list[tuple], any_alias: str) -> Callable[[str], list[tuple]]:
    """A function that gives a text's capped candidates (tier, start, neg, section_idx, alias_idx, end, number of the row, line) in the order of trial: tier, place, longer alias first (but for fallbacks), section, alias."""
    some = re.compile(any_alias)
    tests = [(k, r[4], re.compile(r[6])) for k, r in enumerate(rows)]
    blanks = {32: None, 9: None}

    def of_line(line: str) -> list[tuple[int, int, int]]:
        compact = line.translate(blanks)
        return [(k, *m.span()) for k, alias, p in tests if alias in compact for m in p.finditer(line) if likely_heading(line, *m.span())]

    hits = remembered(of_line)

    def of_text(text: str) -> list[tuple]:
        found, at = [], 0
        while m := some.search(text, at):
            lo, hi = text.rfind("\n", 0, m.start()) + 1, text.find("\n", m.end())
            at = len(text) if hi < 0 else hi
            line = text[lo:at]
            for k, a, b in hits(line):
                s, _, _, i, alias, tier, _ = rows[k]
                found.append((tier, s, i, lo + a, lo + b, -len(alias) if tier < 3 else 0, k, line.strip(BLANKS)))
        found.sort(key=lambda x: x[:4])
        out, counts = [], {}
        for tier, s, i, start, end, neg, k, line in found:
            counts[tier, s] = counts.get((tier, s), 0) + 1
            if counts[tier, s] <= CAPS.get(tier, len(text)) and (tier != 2 or start >= EARLY or len(line) > 6):
                out.append((tier, start, neg, s, i, end, k, line))
        out.sort(key=lambda x: x[:6])
        return out

    return of_text


def searched(docs: DataFrame, sections: DataFrame, text: Column | None = None) -> DataFrame:
    """docs with found: all title candidates of three tiers in the order of trial, capped in alias order: 20 bare titles and 10 fallbacks for each section. Null without a candidate."""
    small_batches(docs.sparkSession)
    rows = [tuple(r) for r in sections.select(*_FIELDS).collect()]  # of a fixed size
    any_alias = catalog.tree({r[_FIELDS.index("alias")] for r in rows})

    @F.arrow_udf(f"array<{_ITEM}>")
    def found(texts: pa.Array) -> pa.Array:
        search = _search(rows, any_alias)
        per = [search(t) if t else [] for t in texts_of(texts)]
        flat = [x for items in per for x in items]
        column = lambda i, kind: pa.array([x[i] for x in flat], kind)
        number = column(6, pa.int32())
        of = lambda name, kind: pa.array([r[_FIELDS.index(name)] for r in rows], kind).take(number)
        fields = {name: column(i, pa.int32()) for i, name in enumerate(("tier", "start", "neg", "section_idx", "alias_idx", "end"))}
        fields |= {"canonical": of("canonical", pa.string()), "ord": of("ord", pa.int32()), "alias": of("alias", pa.string()), "line_text": column(7, pa.string()), "reason": pa.nulls(len(flat), pa.string())}
        return lists([len(items) or None for items in per], fields)

    return docs.withColumn("found", found.asNondeterministic()(F.col("text") if text is None else text))


def candidates(docs: DataFrame, sections: DataFrame) -> DataFrame:
    """All title candidates, one row each."""
    x = searched(docs.select("doc_id", "text"), sections).select("doc_id", F.explode("found").alias("x"))
    return x.select("doc_id", *[f"x.{f}" for f in ("section_idx", "canonical", "ord", "alias_idx", "alias", "tier", "start", "end", "line_text")])


def after_contents(found: Column) -> Column:
    """Candidates without those of contents pages: the first anchor section with a match at 1000 or later, or a numbered one, tells where the text begins.

    What stands before that anchor's neighbourhood goes; fallbacks aren't touched. If no numbered title of the anchor's own section is left, its
    first candidate (by tier and alias) comes back.
    """
    names = F.array(*[F.lit(a) for a in catalog.ANCHORS])
    rank = lambda x: F.array_position(names, x["canonical"])

    def kept(items: Column) -> Column:
        fit = F.filter(items, lambda x: (x["tier"] < 3) & (rank(x) > 0) & ((x["start"] >= EARLY) | (x["tier"] == 1)))
        anchor = F.array_min(F.transform(fit, lambda x: F.struct(rank(x).alias("rank"), x["start"].alias("start"))))
        return let(anchor, lambda a: F.when(a.isNull(), items).otherwise(behind(items, a)))

    def behind(items: Column, a: Column) -> Column:
        own = F.filter(items, lambda x: (x["tier"] < 3) & (rank(x) == a["rank"]))
        late = lambda x: (x["tier"] == 3) | (x["start"] >= a["start"] + ANCHOR_OFFSET)
        order = lambda x: F.struct(x["tier"], x["alias_idx"], x["start"])
        strong = F.exists(own, lambda x: late(x) & (x["tier"] == 1))
        back = F.struct(strong.alias("strong"), F.array_min(F.transform(own, order)).alias("first"))
        return let(back, lambda b: F.filter(items, lambda x: late(x) | ~b["strong"] & (rank(x) == a["rank"]) & (order(x) == b["first"])))

    return let(found, kept)


def judged(items: Column) -> Column:
    """``items`` in their order, each with reason: null if it is accepted, else why not.

    One is accepted if its section is new and no order inverts. A fallback for a section that has a title already isn't even tried, so it is left out.
    """
    name = lambda x: F.concat(x["canonical"], F.lit("("), x["ord"].cast("string"), F.lit(")"))
    inverted = lambda a, b: F.concat(F.lit("section_order_inversion:"), name(a), F.lit(" -> "), name(b))
    twice = lambda c: F.when(c["tier"] == 1, "duplicate_section_not_overwrite").when(c["tier"] == 2, "weak_match_after_strong_exists").otherwise("fallback_after_exists")

    def step(acc: Column, c: Column) -> Column:
        taken = F.filter(acc, lambda a: a["reason"].isNull())
        # neighbours by place among those accepted; of equal places the later accepted comes later
        before = F.filter(taken, lambda a: a["start"] <= c["start"])
        after = F.filter(taken, lambda a: a["start"] > c["start"])
        prev = F.array_max(F.transform(before, lambda a: F.struct(a["start"], a["ord"], a["canonical"])))
        next_ = F.array_min(F.transform(after, lambda a: F.struct(a["start"], a["ord"], a["canonical"])))
        why = let(
            F.struct(F.filter(taken, lambda a: a["canonical"] == c["canonical"]).alias("same"), prev.alias("prev"), next_.alias("next")),
            lambda n: F.when(F.size(n["same"]) > 0, twice(c)).when(c["ord"] < n["prev"]["ord"], inverted(n["prev"], c)).when(n["next"]["ord"] < c["ord"], inverted(c, n["next"])),
        )
        untried = (c["tier"] == 3) & F.exists(taken, lambda a: (a["canonical"] == c["canonical"]) & (a["tier"] < 3))
        return F.when(untried, acc).otherwise(F.concat(acc, F.array(c.withField("reason", why))))

    return F.aggregate(items, F.array().cast(f"array<{_ITEM}>"), step)


def merged_audit(accepted: Column, near: int = 500) -> Column:
    """Accepted ones by place; an audit report's title less than ``near`` characters from a neighbouring financial report gets a reason: it goes into that one."""
    by_place = F.array_sort(accepted, lambda a, b: F.when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1)).when(a["ord"] != b["ord"], F.when(a["ord"] < b["ord"], -1).otherwise(1)).otherwise(F.when(a["section_idx"] < b["section_idx"], -1).when(a["section_idx"] > b["section_idx"], 1).otherwise(0)))

    def marked(items: Column) -> Column:
        beside = lambda n, x: F.coalesce((n["canonical"] == "财务报告") & (F.abs(n["start"] - x["start"]) < near), F.lit(False))
        drop = lambda x, i: (x["canonical"] == "审计报告") & (beside(F.get(items, i - 1), x) | beside(F.get(items, i + 1), x))
        return F.transform(items, lambda x, i: F.when(drop(x, i), x.withField("reason", F.lit("merged_into_adjacent_财务报告"))).otherwise(x))

    return let(by_place, marked)


def decided(found: DataFrame) -> DataFrame:
    """found (... , found) with kept, accepted and rejected: candidates behind the contents, boundaries by place, and the others with their reasons; null where found is."""
    kept = found.withColumn("kept", after_contents(F.col("found")))
    tried = kept.withColumn("tried", judged(F.col("kept")))
    merged = tried.withColumn("merged", merged_audit(F.filter("tried", lambda x: x["reason"].isNull())))
    out = F.concat(F.filter("tried", lambda x: x["reason"].isNotNull()), F.filter("merged", lambda x: x["reason"].isNotNull()))
    return merged.withColumns({"accepted": F.filter("merged", lambda x: x["reason"].isNull()), "rejected": out}).drop("tried", "merged")


def boundaries(docs: DataFrame, sections: DataFrame) -> DataFrame:
    """(doc_id, text, found, kept, accepted, rejected) of documents with a candidate."""
    return decided(searched(docs.select("doc_id", "text"), sections).filter("found IS NOT NULL"))


PREAMBLE = "前言及重要提示"


def parts(text: Column, accepted: Column) -> Column:
    """array<struct<ord,canonical,start,end,content>>: each boundary runs to the next; text before the first is a preamble unless blank. Null without a boundary."""
    head = F.struct(F.lit(10).alias("ord"), F.lit(PREAMBLE).alias("canonical"), F.lit(0).alias("start"))
    marks = F.concat(F.array(head), F.transform(accepted, lambda x: F.struct(x["ord"].alias("ord"), x["canonical"].alias("canonical"), x["start"].alias("start"))))

    def closed(ms: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            end = F.coalesce(F.get(ms, i + 1)["start"], F.length(text))
            return F.struct(x["ord"].alias("ord"), x["canonical"].alias("canonical"), x["start"].alias("start"), end.alias("end"), F.substring(text, x["start"] + 1, end - x["start"]).alias("content"))

        return F.transform(ms, one)

    # the preamble of a text that begins with a title is empty
    return F.when(F.size(accepted) > 0, F.filter(let(marks, closed), lambda x: (x["canonical"] != PREAMBLE) | x["content"].rlike(r"(?U)\S")))


def spans(cut: DataFrame) -> DataFrame:
    """(doc_id, ord, canonical, start, end, content) of ``boundaries``: every text is cut in its own row."""
    return cut.select("doc_id", F.explode(parts(F.col("text"), F.col("accepted"))).alias("x")).select("doc_id", "x.*")


def split_sections(docs: DataFrame, sections: DataFrame) -> DataFrame:
    """Gate, candidates, contents skipping, selection, audit merge, spans: (doc_id, ord, canonical, start, end, content)."""
    good = quality_gate(docs).filter("status = 'accepted'").select("doc_id", "text")
    return spans(boundaries(good, sections))


def lossless(docs: DataFrame, sections: DataFrame) -> DataFrame:
    """(doc_id, lossless): whether a document's spans add up to its text."""
    joined = sections.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "content"))), lambda x: x["content"]), "").alias("whole"))
    return docs.join(joined, "doc_id").select("doc_id", (F.col("whole") == F.col("text")).alias("lossless"))


def whole_again(docs: DataFrame, sections: DataFrame) -> DataFrame:
    """(doc_id, lossless) of ``docs`` as ``lossless`` has it for their own spans, which are added up where they were cut."""
    good = quality_gate(docs).filter("status = 'accepted'").select("doc_id", "text")
    own = boundaries(good, sections).select("doc_id", "text", F.transform(parts(F.col("text"), F.col("accepted")), lambda x: x["content"]).alias("contents"))
    return own.filter("contents IS NOT NULL").select("doc_id", (F.array_join("contents", "") == F.col("text")).alias("lossless"))


def details(docs: DataFrame, sections: DataFrame) -> DataFrame:
    """A row for each document: the metadata of its split.

    status is the gate's, or failed without any boundary, warning if a section is blank, else success; status_rank orders
    reports. raw_matches, after_contents and final count candidates; section_sizes maps names to code points; missing_before
    and missing list catalogue sections without a title before fallbacks and after them; accepted and rejected hold the
    boundaries and the other candidates, with previews of their lines and reasons.
    """
    gated = quality_gate(docs)
    cut = decided(searched(gated, sections, F.when(F.col("status") == "accepted", F.col("text"))))
    of_parts = let(parts(F.col("text"), F.col("accepted")), lambda ps: F.struct(
        F.map_from_entries(F.array_sort(F.transform(ps, lambda x: F.struct(x["canonical"], F.length(x["content"]))))).alias("section_sizes"),
        F.array_sort(F.transform(F.filter(ps, lambda x: ~x["content"].rlike(r"(?U)\S")), lambda x: x["canonical"])).alias("empty_sections"),
    ))
    names = F.array(*[F.lit(n) for n in catalog.SECTIONS])
    none = F.array().cast("array<string>")
    of = lambda items: F.transform(items, lambda x: x["canonical"])
    shown = lambda items: F.transform(
        items, lambda x: F.struct(x["canonical"].alias("name"), x["start"].alias("position"), x["end"].alias("end"), x["alias"].alias("matched_alias"), F.substring(x["line_text"], 1, 100).alias("line_preview"), F.element_at(F.create_map(*[F.lit(v) for kv in SOURCES.items() for v in kv]), x["tier"]).alias("source"), x["tier"].alias("tier"), x["ord"].alias("order"), x["reason"].alias("reject_reason"))
    )
    d = cut.withColumns({"total_chars": F.length("text"), "_parts": of_parts}).drop("text").withColumns({"section_sizes": F.col("_parts.section_sizes"), "empty_sections": F.col("_parts.empty_sections")})
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    status = F.when(F.col("status") != "accepted", F.col("status")).when(size(F.col("accepted")) <= 0, "failed").when(size(F.col("empty_sections")) > 0, "warning").otherwise("success")
    rank = "CASE status WHEN 'failed' THEN 0 WHEN 'warning' THEN 1 WHEN 'success' THEN 2 WHEN 'ignored_summary' THEN 3 ELSE 4 END"
    tested = F.col("status") == "accepted"
    primary = lambda c: F.filter(c, lambda x: x["tier"] < 3)
    return d.select(
        "doc_id", status.alias("status"), "reason", "total_chars", F.greatest(size(primary("found")), F.lit(0)).alias("raw_matches"), F.greatest(size(primary("kept")), F.lit(0)).alias("after_contents"),
        F.greatest(size(F.col("accepted")), F.lit(0)).alias("final"), "section_sizes", F.coalesce("empty_sections", none).alias("empty_sections"),
        F.when(tested, F.array_except(names, F.coalesce(of(F.filter(F.concat("accepted", "rejected"), lambda x: (x["tier"] < 3) & (x["reason"].isNull() | x["reason"].startswith("merged")))), none))).alias("missing_before"),
        F.array_except(names, F.coalesce(of(F.col("accepted")), none)).alias("missing"), F.coalesce(F.exists("accepted", lambda x: x["tier"] == 3), F.lit(False)).alias("used_fallback"),
        shown(F.col("accepted")).alias("accepted"), shown(F.col("rejected")).alias("rejected"),
    ).withColumn("status_rank", F.expr(rank))
