"""Quality rules by weak supervision.

Rules vote 1 (good), 0 (bad) or abstain (-1) on each text. Expectation-maximisation over the counts of vote patterns of
all documents estimates how far each rule can be trusted, and each document gets the posterior probability of being
good. Only pattern counts reach the driver: at most 3 to the power of the number of rules rows, however many documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, small_batches, written

SYMBOLS = "#*$%&|<>"
RULES = ("symbols", "repeats", "lines", "word_length", "letters", "length", "variety", "sentences")
SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, votes array<int>"
#: Above the first number a rule votes bad, below the second good, between them it abstains.
SHARE = {"symbols": (0.1, 0.02), "repeats": (0.2, 0.05), "lines": (0.2, 0.02)}
KEEP_AT = 0.5


def repeat_words(words: list[str]) -> int:
    """Words in 3-word windows that occur twice or more in the text, the first time included."""
    n = len(words) - 2
    if n < 2:
        return 0
    counts = Counter(zip(words, words[1:], words[2:]))
    if len(counts) == n:
        return 0
    hit = np.zeros(n + 2, bool)
    again = np.fromiter((counts[w] > 1 for w in zip(words, words[1:], words[2:])), bool, n)
    for k in range(3):
        hit[k : k + n] |= again
    return int(hit.sum())


def measure(text: str | None) -> tuple[int, int, int, int, int, list[int]]:
    """The base figures of a whole text and its votes. A null text has no words."""
    text = text or ""
    words = WORD.findall(text)
    n, chars = len(words), sum(map(len, words))
    symbols = sum(map(text.count, SYMBOLS))
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    repeats = repeat_words(words)
    return n, chars, symbols, dup, repeats, votes(text, words, n, chars, symbols, dup, lines, repeats)


def votes(text, words, n, chars, symbols, dup, lines, repeats) -> list[int]:
    if not n:
        return [-1, -1, -1, 0, 0, 0, -1, -1]
    graded = lambda x, rule: 0 if x > SHARE[rule][0] else 1 if x <= SHARE[rule][1] else -1
    mean = chars / n
    letters = sum(w.isalpha() or w[:-1].isalpha() for w in words) / n
    kinds = len(set(words)) / math.sqrt(n)
    ends = text.count(".") + text.count("!") + text.count("?") + text.count("。")
    return [
        graded(symbols / n, "symbols"),
        graded(repeats / n, "repeats"),
        graded(dup / lines, "lines"),
        1 if 2.5 <= mean <= 8.5 else 0 if not 2 <= mean <= 12 else -1,
        1 if letters >= 0.9 else 0 if letters < 0.7 else -1,
        1 if n >= 100 else 0 if n < 50 else -1,
        1 if kinds >= 4 else 0 if kinds < 2 else -1,
        1 if n / 40 <= ends <= n / 3 else 0 if ends < n / 120 else -1,
    ]


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` and SCHEMA's."""
    small_batches(docs.sparkSession)
    fields = [docs.schema[c] for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [measure(t) for t in b.column(len(keep)).to_pylist()]
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(len(keep))), *(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.list_(pa.int32()))],
                names=[*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "votes"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", " + SCHEMA
    return docs.select(*[F.col(f"`{c}`") for c in keep], "text").mapInArrow(run, schema) if "text" not in keep else docs.select(
        *[F.col(f"`{c}`") for c in keep], F.col("text").alias("_text")).mapInArrow(run, schema)


def posterior(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, trust: float = 0.25) -> tuple[np.ndarray, np.ndarray]:
    """EM with a class-conditional distribution of {abstain, bad, good} for each rule.

    patterns: (P, R) of -1, 0, 1. A bad vote is held to be rare for good texts (3 in 100) and common for bad ones (4 in
    10): a text is bad when one thing is wrong with it, good when nothing is. EM starts from that and is smoothed
    towards it with the weight of ``trust`` times all documents, so the classes can't change places or take up another
    meaning, such as length. Returns P(good) of each pattern, and each rule's estimated accuracy when it votes.
    """
    p, r = patterns.shape
    onehot = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)  # (P, R, 3)
    total = max(counts.sum(), 1.0)
    silent = np.clip((onehot[:, :, 0] * counts[:, None]).sum(0) / total, 0.01, 0.99)
    base = np.empty((2, r, 3))
    for y, bad in ((0, 0.4), (1, 0.03)):
        base[y, :, 0], base[y, :, 1], base[y, :, 2] = silent, (1 - silent) * bad, (1 - silent) * (1 - bad)
    theta, good, q = base, 0.7, np.zeros((p, 2))
    for _ in range(rounds):
        log = np.einsum("prv,yrv->py", onehot, np.log(theta)) + np.log([1 - good, good])
        q = np.exp(log - log.max(1, keepdims=True))
        q /= q.sum(1, keepdims=True)
        w = q * counts[:, None]
        new = np.einsum("py,prv->yrv", w, onehot) + trust * total * base
        new /= new.sum(2, keepdims=True)
        good = min(max((w[:, 1].sum() + 0.7 * trust * total) / (total * (1 + trust)), 0.05), 0.95)
        moved, theta = np.abs(new - theta).max(), new
        if moved < 1e-9:
            break
    agree = theta[0, :, 1] * (1 - good) + theta[1, :, 2] * good
    voted = (theta[0, :, 1] + theta[0, :, 2]) * (1 - good) + (theta[1, :, 1] + theta[1, :, 2]) * good
    return q[:, 1], agree / np.maximum(voted, 1e-9)


def judge(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs``, the base figures, base_failed, p_good and kept.

    kept is false where base_failed (fewer than 50 words, or more than half of them in repeated 3-word windows), and
    else whether p_good is KEEP_AT or more. The model is fitted on all rows, repeated ones included. A null or empty
    text has no words and fails. An empty table gives no rows. Only ``keep`` and ``text`` are read, so other columns
    may have any name; names in ``keep`` that clash with a result's column are the caller's to rename.
    """
    spark = docs.sparkSession
    base = written(measured(docs, keep), "quality")
    rows = base.groupBy("votes").count().collect()  # at most 3 ** len(RULES) rows
    patterns = np.array([r[0] for r in rows], int).reshape(len(rows), len(RULES))
    order = np.lexsort(patterns.T) if len(rows) else np.zeros(0, int)
    patterns, counts = patterns[order], np.array([r[1] for r in rows], float)[order]
    p = posterior(patterns, counts)[0] if len(rows) else np.zeros(0)
    model = spark.createDataFrame([(list(map(int, a)), float(b)) for a, b in zip(patterns, p)], "votes array<int>, p_good double")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        base.join(F.broadcast(model), "votes", "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= KEEP_AT))
        .select(*[F.col(f"`{c}`") for c in keep], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("p_good", 9).alias("p_good"))
    )
