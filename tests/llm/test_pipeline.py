"""The pipeline: each stage keeps the columns, its decisions take effect, and the end agrees with plain Python."""

import hashlib
import random
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from reportloom.llm import bpe, quality

D = "/root/testdata/sf0.001"


def test_run(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, left, D).cache()
        assert kept.columns == docs.columns and kept.count() <= left.count()
        left = kept
    texts = {r.doc_id: r.text for r in left.collect()}
    good = {r.doc_id for r in quality.judge(docs, ["doc_id"]).filter("kept").collect()}
    assert set(texts) <= good
    own = bpe.WordBpe(open(bpe.default_path(), encoding="utf-8").read())
    want = {i: (n, hashlib.sha256(ids.encode()).hexdigest()) for (i, t) in texts.items() for n, ids, _ in own.encode_batch([t])}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, D).collect()}
    assert got == want


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_run_against_plain_python(spark, tmp_path):
    """run() on a small table with nulls, repeated rows and doc_ids, against brute force: only the rules' posterior and the surrogates come from the operators."""
    tokenizers = pytest.importorskip("tokenizers")
    prose = lambda seed, n: " ".join(random.Random(seed).choice(["river", "stone", "lamp", "garden", "window", "paper", "silver", "morning", "letter", "bridge", "yellow", "winter"]) + str(random.Random(seed * 997 + k).randrange(40)) for k in range(n)) + "."
    rows = [(k, prose(k, 120)) for k in range(12)]
    for k in range(3):  # near copies: every ninth word another one
        rows.append((20 + k, " ".join(w if i % 9 else f"other{k}" for i, w in enumerate(rows[k][1].split()))))
    item = prose(99, 30)
    rows += [(30, prose(30, 60) + " " + item + " " + prose(31, 60)), (4, rows[4][1]), (5, prose(50, 110)), (None, rows[6][1]), (None, prose(51, 110)), (40, None), (41, ""), (42, "short text"), (43, prose(43, 100) + " write to someone@mail.example.org now")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", None, len(t or "")) for i, t in rows], schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    measured = [quality.measure(t) for _, t in rows]
    counts = Counter(tuple(m[5]) for m in measured)
    patterns = np.array(sorted(counts))
    p = dict(zip(map(tuple, patterns), quality.posterior(patterns, np.array([float(counts[tuple(x)]) for x in patterns]))[0]))
    left = [r for r, m in zip(rows, measured) if m[0] >= 50 and 100 * m[4] <= 50 * m[0] and p[tuple(m[5])] >= quality.KEEP_AT]
    words = [t.lower().split() for _, t in left]
    group = list(range(len(left)))
    for a in range(len(left)):
        for b in range(a):
            if distance(words[a], words[b]) <= 0.2 * max(len(words[a]), len(words[b])) + 1e-9:
                group = [group[b] if g == group[a] else g for g in group]
    first = {}
    for (i, t), g in zip(left, group):
        best = first.get(g)
        if best is None or (i is None, i or 0) < (best[0] is None, best[0] or 0):
            first[g] = (i, t)
    grams = lambda t: {tuple(w) for w in zip(*[t.lower().split()[k:] for k in range(5)])}
    clean = [r for r in first.values() if len(grams(item) & grams(r[1])) < 0.8 * len(grams(item))]
    assert {20, 21, 22, 30} & {i for i, _ in clean} == set() and len(clean) >= 12
    lib = tokenizers.Tokenizer.from_file(bpe.default_path())
    digest = lambda t: hashlib.sha256(" ".join(map(str, lib.encode(t, add_special_tokens=False).ids)).encode()).hexdigest()
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.ids_sha256) for r in got if r.doc_id != 43) == sorted((str(i), digest(t)) for i, t in clean if i != 43)
    assert [r.ids_sha256 != digest(rows[-1][1]) for r in got if r.doc_id == 43] == [True]


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
