"""Boundaries against plain Python on the synthetic reports, and files in and out."""

import re

from pyspark.sql import functions as F

from reportloom.operators import catalog, split
from reportloom.plans import queries as q
from reportloom.sources import files
from reportloom.streaming.ingest import ingest

D = "/root/testdata/sf0.001"


def heading(line, a, b):
    s = line.strip()
    after, before, hit = s[b:], s[:a].strip(), s[a:b]
    if not s or sum(after.count(c) for c in ".．…·") > 5 or s.count("/") > 1 or s.count("-") > 2 or s.count("—") > 1:
        return False
    if re.match(r"^\d+$", after.strip()) or re.search(r"\s{5,}\d+$", s) or re.match(r"^\d+\s+", s):
        return False
    if re.search("详见|参见|请参阅|参考|阅读|查阅", before) or re.search('["“”]', before):
        return False
    if re.search(catalog.NUMBERING, hit):
        return True
    header = bool(re.search(catalog.PAGE_HEADER, before))
    if before and not header and not re.match(rf"^(?:{catalog.NUMBERING}|\d+\s*[、.．])?$", before) and len(before) <= 20 and re.search("[一-龥]{3,}", before):
        return False
    return (b - a) / len(s) >= (0.1 if header else 0.25)


def test_candidates(spark):
    docs = split.quality_gate(q.reports(spark, D)).filter("status = 'accepted'").select("doc_id", "text")
    got = {tuple(r) for r in split.candidates(docs, catalog.section_catalog(spark)).select("doc_id", "canonical", "tier", "alias_idx", "start").collect()}
    rows, want = catalog.section_catalog(spark).collect(), set()
    for doc_id, text in docs.collect():
        counts = {}
        for c in sorted(rows, key=lambda c: (c.section_idx, c.tier, c.alias_idx)):
            for m in re.finditer(c.regex, text):
                lo = text.rfind("\n", 0, m.start()) + 1
                hi = text.find("\n", m.start())
                line = text[lo : hi if hi >= 0 else len(text)]
                if not heading(line, m.start() - lo, m.end() - lo):
                    continue
                k = (c.section_idx, c.tier)
                counts[k] = counts.get(k, 0) + 1
                if counts[k] > {1: 10**9, 2: 20, 3: 10}[c.tier]:
                    continue
                if c.tier == 2 and m.start() < 1000 and len(line.strip()) <= 6:
                    continue
                want.add((doc_id, c.canonical, c.tier, c.alias_idx, m.start()))
    assert got == want


def test_spans_add_up(spark):
    r = q.reports(spark, D)
    s = split.split_sections(r, catalog.section_catalog(spark)).cache()
    assert s.count() > 500
    assert split.lossless(r, s).filter("NOT lossless").count() == 0
    assert s.groupBy("doc_id", "canonical").count().filter("count > 1").count() == 0


def test_files(spark, tmp_path):
    for name, raw in (("a_b_2020", "中文\r\n第二行".encode()), ("c", "﻿有标记".encode()), ("d", "国标编码的文字".encode("gb18030"))):
        (tmp_path / f"{name}.txt").write_bytes(raw)
    got = {r.doc_id: r.text for r in files.read_mixed(spark, str(tmp_path)).collect()}
    assert got == {"a_b_2020": "中文\n第二行", "c": "有标记", "d": "国标编码的文字"}


def test_ingest_takes_rows_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    docs = spark.createDataFrame([(1, "x"), (2, "y")], "doc_id long, text string")
    docs.write.parquet(src)
    run = lambda: ingest(spark, src, "doc_id long, text string", lambda d: split.quality_gate(d).select("doc_id", "status"), out, ck)
    assert run() == 2
    docs.withColumn("doc_id", F.col("doc_id") + 2).write.mode("append").parquet(src)
    assert run() == 2
    assert sorted(r.doc_id for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4]
