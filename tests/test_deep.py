"""Folds over titles, boundaries and blocks against plain Python."""

import re

from pyspark.sql import functions as F

from reportloom.operators import boundaries, financial, layout, linescore
from reportloom.plans import queries as q

D = "/root/testdata/sf0.001"


def by_doc(df, *cols):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(tuple(r[c] for c in cols))
    return {k: sorted(v) for k, v in out.items()}


def all_of(text, part):
    return [m.start() for m in re.finditer(re.escape(part), text)]


def blocks_of(points, text, lead):
    points = sorted({(0, -1, lead), *points})
    cut = [p[0] for p in points[1:]] + [len(text)]
    return [(t, s, e) for (s, _, t), e in zip(points, cut) if e > s]


def test_deep_split(spark):
    docs = q.financials(spark, D)
    got, lines = by_doc(financial.deep_split(docs), "sub_idx", "title", "start", "end", "tier"), by_doc(financial.deep_split_lines(docs), "start", "title", "end")
    for doc_id, text in docs.collect():
        points, at, notes_at = [], 0, None
        for s in financial.STATEMENTS:
            where = [p for p in all_of(text, s) if p >= at]
            if where:
                points.append((where[0], 0, s))
                at = where[0] + len(s)
                notes_at = where[0] if s == "财务报表附注" else notes_at
        if notes_at is not None:
            points += [(m.start() + 1, 1, m[1]) for m in re.compile(r"\n([一二三四五六七八九十]+、\s*[^。\n]{2,30})(?=\n|$)").finditer(text, notes_at)]
        want = blocks_of(points, text, "财务报告_前言")
        assert [r[1:4] for r in got[doc_id]] == want and [r[0] for r in got[doc_id]] == list(range(len(want)))
        assert {r[4] for r in got[doc_id] if "关联方" in r[1]} <= {"HIGH_RISK_NOTES"}
        points = [(m.start(), k, s) for k, s in enumerate(financial.ALL_STATEMENTS) for m in re.finditer(rf"(?:^|\n)\s*{s}\s*\n", text)]
        points += [(m.start(), 10, "附注_" + m[1].strip()) for m in re.finditer(r"(?:^|\n)\s*([一二三四五六七八九十]+、\s*[^\n]{2,30})\s*\n", text) if re.search("|".join(financial.KEY_NOTES), m[1])]
        want = blocks_of(points, text, "财务报告_前言")
        want = [("财务报告_未细分", 0, len(text))] if len(want) == 1 and want[0][0] == "财务报告_前言" else want
        assert [(t, s, e) for s, t, e in lines[doc_id]] == want


def test_issuer_slices(spark):
    texts = [(n, "编制单位..".join(["头"] * (n + 1))) for n in range(12)] + [(99, None)]
    got = by_doc(financial.by_issuer(spark.createDataFrame(texts, "doc_id int, text string")), "start", "end", "sub")
    for n, text in texts[:-1]:
        p = all_of(text, "编制单位")
        cuts = [0, *p[0:10:2]][:6] + [len(text)] if n >= 4 else []
        assert [(a, b) for a, b, _ in got.get(n, [])] == list(zip(cuts, cuts[1:])), n
    assert 99 not in got


def test_place_titles(spark):
    body = "字" * 400
    texts = [
        (1, "甲章 乙章 丙章" + body + "甲章" + body + "乙章" + body + "丙章"), (2, "甲章乙章"), (3, "丙章" + body + "甲章" + body), (4, ""), (5, None),
        (6, "甲章甲章" + body + "甲章" + "字" * 298 + "乙章" + body + "丙章"),
    ]
    names = ["甲章", "乙章", "丙章"]
    docs = spark.createDataFrame([(k, t, names) for k, t in texts], "doc_id int, text string, titles array<string>")
    got = by_doc(financial.place_titles(docs), "idx", "pos")
    for k, text in texts:
        at, want = 0, []
        for i, name in enumerate(names):
            for p in [p for p in all_of(text or "", name) if p >= at]:
                at = p + len(name)
                if not any(at <= r < p + 300 for n in names[i + 1 : i + 2] for r in all_of(text, n)):
                    want.append((i, p))
                    break
        assert got.get(k, []) == want, k


def test_pick_and_sections(spark):
    reports = q.reports(spark, D)
    docs = reports.withColumn("text", linescore.normalised(F.col("text")))
    found = linescore.scored_lines(docs).cache()
    got, items = by_doc(linescore.pick(found), "section_idx", "start"), by_doc(found.filter("canonical NOT LIKE '\\_%'"), "section_idx", "start")
    for doc_id, titles in items.items():
        last, want = -1, []
        for s in range(9):
            kept = []
            for k, start in titles:
                if k == s and (not kept or start - kept[-1] >= 500):
                    kept.append(start)
            later = [x for x in kept if x > last]
            if later:
                last = later[0]
                want.append((s, last))
        assert got[doc_id] == want
    rows = by_doc(linescore.sections(docs), "ord", "status", "start", "end")
    assert len(rows) == docs.count() and all(len(r) == 9 for r in rows.values())
    assert all((s == "missing") == (a is None) for r in rows.values() for _, s, a, _ in r)


def test_normalised(spark):
    t = [("a\r\nb\rc　d\t\t e\n\n\n\n\nf\n12第一节 x  ",), ("",), (None,)]
    got = [r[0] for r in spark.createDataFrame(t, "t string").select(linescore.normalised(F.col("t"))).collect()]
    assert got == ["a\nb\nc d e\n\n\nf\n第一节 x\n", "\n", None]


def test_boundaries(spark):
    rows = [(1, 0, "a", 0.5), (1, 100, "a", 0.9), (1, 4000, "b", 0.5), (1, 4500, "a", 0.9), (1, 9000, "a", 0.95), (2, 0, "a", 0.5), (2, 6000, "a", 0.5)]
    b = spark.createDataFrame(rows, "doc_id int, pos int, canonical string, confidence double")
    assert by_doc(boundaries.merge_near(b), "pos", "canonical", "confidence") == {1: [(4000, "b", 0.5), (9000, "a", 0.95)], 2: [(0, "a", 0.5)]}
    text = "重要提示\n" + "字" * 12000 + "\n第三节 董事会报告\n" + "字" * 50000 + "\n监事会\n" + "字" * 20 + "\n股东大会\n"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id int, text string")
    have = spark.createDataFrame([(1, 200, "公司简介和主要财务指标", 0.9)], "doc_id int, pos int, canonical string, confidence double")
    got = by_doc(boundaries.fill_missing(docs, have), "pos", "canonical", "confidence")
    assert got == {1: [(200, "公司简介和主要财务指标", 0.9), (text.index("第三节"), "管理层讨论与分析", 0.5), (text.index("股东大会"), "公司治理", 0.5)]}
    near = "第一节 重要提示" + "字" * 900 + "第二节 公司简介" + "字" * 3000 + "第二节 主要财务指标" + "字" * 9000 + "第三节 管理层讨论"
    got = by_doc(boundaries.content_points(spark.createDataFrame([(1, near), (2, None)], "doc_id int, text string")), "pos")
    assert got == {1: [(0,), (near.index("第二节 主要"),), (near.index("第三节"),)]}
    names = spark.createDataFrame([("第一节 公司治理",), ("释义",), ("无关",), ("重大事项说明",)], "t string").select(boundaries.canonical_name(F.col("t")))
    assert [r[0] for r in names.collect()] == ["公司治理", "重要提示_目录_释义", None, "重要事项"]


def test_blocks(spark):
    blocks = q.blocks(spark, D).cache()
    lines, pairs = by_doc(layout.page_lines(blocks), "line_no", "text"), by_doc(layout.column_entries(blocks), "title", "target")
    for doc_id, items in by_doc(blocks, "y0", "x0", "x1", "text", "y1", "size").items():
        want, top = [], None
        for y, x, x1, t, *_ in items:
            if top is None or y - top > 8:
                top = y
                want.append([])
            want[-1].append((x, x1, t))
        flat = []
        for line in want:
            line.sort(key=lambda b: b[0])
            for k, (x, _, t) in enumerate(line):
                if k and x - line[k - 1][1] <= 200:
                    flat[-1].append(t)
                else:
                    flat.append([t])
        assert [t for _, t in lines[doc_id]] == [" ".join(f) for f in flat], doc_id
        titles, taken, want = [b for b in items if not b[3].isdigit()], set(), []
        for n in [b for b in items if b[3].isdigit() and b[5] > 20]:
            near = sorted((abs((b[0] + b[4]) / 2 - (n[0] + n[4]) / 2), k) for k, b in enumerate(titles) if k not in taken)
            if near and near[0][0] < 15:
                taken.add(near[0][1])
                want.append((titles[near[0][1]][3], int(n[3])))
        assert pairs.get(doc_id, []) == sorted(want), doc_id
