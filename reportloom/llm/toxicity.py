"""Toxicity by a counterfactual-regularised classifier.

A logistic model over the distinct words of a text and their beginnings (hashed) is fitted on a bounded sample of labelled documents. Each
sentence set is also seen with its identity terms, plain or inflected, swapped within their category, word beginnings
included; the squared change of the score is penalised, so that naming a group moves no score. An L1 step keeps only words that bear evidence.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written

#: Identity terms that are swapped within a row.
IDENTITY = (
    ("man", "woman", "men", "women", "boy", "girl", "male", "female", "nonbinary", "transgender"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "homosexual", "heterosexual"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("black", "white", "asian", "latino", "african", "european", "american", "arab", "indian", "chinese", "mexican"),
    ("young", "old", "elderly", "teenage"),
    ("deaf", "blind", "disabled", "paralyzed", "autistic"),
    ("immigrant", "refugee", "foreigner", "native"),
)
#: Endings of inflected identity terms; they stay when a term is swapped.
ENDINGS = ("", "s", "es", "ness")
#: The versions of a text together weigh as much as this many.
VERSIONS = 3
WORDS = re.compile(r"\w+")
#: Labelled rows that the fit may use; which ones is a hash's choice.
SAMPLE_ROWS = 20_000
BUCKETS = 1 << 18
#: Entries summed at a time in the fit.
BLOCK = 1 << 20
THRESHOLD = 0.3


def bucket(word: str) -> int:
    """FNV-1a over UTF-8, so that every worker agrees."""
    h = 0xCBF29CE484222325
    for c in word.encode("utf-8", "surrogatepass"):
        h = (h ^ c) * 0x100000001B3 & 0xFFFFFFFFFFFFFFFF
    return (h ^ h >> 29) % BUCKETS


def held_out(doc_id):
    """A column: the contract's fold of a row, never learned from. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def buckets(word: str) -> tuple[int, ...]:
    """A word's own bucket and those of its beginnings of 4 and 5 letters, which tell inflected forms."""
    return (bucket(word), *(bucket(f"{word[:k]}-") for k in (4, 5) if len(word) > k))


class Cache(dict):
    """Buckets (or weights) of words, as far as a bound."""

    def __init__(self, make, most: int = 500_000) -> None:
        self.make, self.most = make, most

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        self[word] = x = self.make(word)
        return x


def forms() -> dict[str, list[str]]:
    """What each identity term, and each inflected form, may be swapped for."""
    out: dict[str, list[str]] = {}
    for end in ENDINGS:
        for row in IDENTITY:
            for term in row:
                out.setdefault(term + end, [other + end for other in row if other != term])
    return out


FORMS = forms()


def versions(words: set[str], of) -> list[int]:
    """The counterfactual versions of a text, as what changes: bucket + 1 where one comes, less than zero where one goes, and 0 after each version.

    A version has each identity term replaced by another of its category and all else as it was, beginnings that other
    words have too included. There are as many versions as it takes to see every alternative of every term.
    """
    terms = sorted(w for w in words if w in FORMS)
    if not terms:
        return []
    rest = {k for w in words.difference(terms) for k in of[w]}
    own = rest.union(*(of[w] for w in terms))
    out = []
    for shift in range(max(len(FORMS[w]) for w in terms)):
        new = rest.union(*(of[FORMS[w][(k + shift) % len(FORMS[w])]] for k, w in enumerate(terms)))
        out += [*(k + 1 for k in sorted(new - own)), *(-k - 1 for k in sorted(own - new)), 0]
    return out


def features(docs: DataFrame) -> DataFrame:
    """The distinct buckets of each text's words and its counterfactual versions, beside the other columns given (doc_id, toxic)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Cache(buckets)
        for b in batches:
            words = [set(WORDS.findall((t or "").lower())) for t in b.column("text").to_pylist()]
            ids = [sorted({k for w in ws for k in of[w]}) for ws in words]
            swaps = [versions(ws, of) for ws in words]
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(ids, pa.list_(pa.int32())), pa.array(swaps, pa.list_(pa.int32()))], names=["toxic", "ids", "swaps"])

    return docs.select("toxic", "text").mapInArrow(run, "toxic int, ids array<int>, swaps array<int>")


def swapped(swaps: np.ndarray, lens: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, weight of each version), (version, word, +1 or -1) of all texts' versions, one text after the other (``lens`` of each). Only words seen in the sample count."""
    row = np.repeat(np.arange(len(lens)), lens)
    end = swaps == 0
    text = row[end]
    weight = VERSIONS / np.bincount(text, minlength=len(lens))[text]
    version = (np.cumsum(end) - end)[~end]
    word = place[np.abs(swaps[~end]) - 1]
    seen = word >= 0
    return text, weight, version[seen], word[seen], np.sign(swaps[~end])[seen].astype(float)


def fit(ids: np.ndarray, lens: np.ndarray, y: np.ndarray, swaps: np.ndarray, swap_lens: np.ndarray, counterfactual: float = 2.0, l1: float = 3e-4, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights by bucket and the bias, by accelerated proximal gradient steps from zero.

    ids: the buckets of all texts, one text after the other (``lens`` of each); swaps: their versions, likewise. The same rows in any order give the same
    model up to rounding. Sums go over BLOCK entries at a time, so memory is 8 bytes an entry and a few arrays of a block.
    """
    n = len(lens)
    w, bias = np.zeros(BUCKETS), 0.0
    if not n or y.min() == y.max():
        return w, (math.log((y.sum() + 0.5) / (n - y.sum() + 0.5)) if n else -5.0)
    row = np.repeat(np.arange(n, dtype=np.int32), lens)
    count = np.bincount(ids, minlength=BUCKETS)
    used = np.flatnonzero(count)
    place = np.full(BUCKETS, -1, np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    text, weight, version, word, sign = swapped(swaps, swap_lens, place)
    col = place[ids]
    blocks = [slice(k, k + BLOCK) for k in range(0, len(col), BLOCK)]
    m = len(text)

    def by_text(z: np.ndarray) -> np.ndarray:
        out = np.zeros(n)
        for at in blocks:
            out += np.bincount(row[at], z[col[at]], minlength=n)
        return out

    def by_word(e: np.ndarray) -> np.ndarray:
        out = np.zeros(len(used))
        for at in blocks:
            out += np.bincount(col[at], e[row[at]], minlength=len(used))
        return out

    v, b = np.zeros(len(used)), math.log(y.mean() / (1 - y.mean()))
    rate = 1.0 / np.sqrt(count[used] + 1.0)  # a step for each word by how common it is
    z, zb, t = v.copy(), b, 1.0
    sig = lambda s: 1 / (1 + np.exp(-np.clip(s, -30, 30)))
    step = 2.0
    for _ in range(rounds):
        s = by_text(z) + zb
        e = (sig(s) - y) / n
        far = 0.0
        if m:
            was = sig(s[text])
            now = sig(s[text] + np.bincount(version, sign * z[word], minlength=m))
            diff = 2 * counterfactual * weight * (was - now) / n
            da, db = diff * was * (1 - was), -diff * now * (1 - now)
            e += np.bincount(text, da + db, minlength=n)
            far = np.bincount(word, sign * db[version], minlength=len(used))
        g, gb = by_word(e) + far, e.sum()
        lr = step * n * rate / max(1.0, math.sqrt(n)) / 4
        new = z - lr * g
        new = np.sign(new) * np.maximum(np.abs(new) - lr * l1, 0)
        nb = zb - step * gb
        nt = (1 + math.sqrt(1 + 4 * t * t)) / 2
        if ((z - new) @ (new - v)) > 0:  # restart when the momentum points uphill
            nt, t = 1.0, 1.0
        z, zb = new + (t - 1) / nt * (new - v), nb + (t - 1) / nt * (nb - b)
        v, b, t = new, nb, nt
    w[used] = v
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, float]:
    """Fits on at most ``sample_rows`` labelled rows outside the held-out fold: those with the least hash of doc_id."""
    small_batches(docs.sparkSession)
    chosen = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )
    chosen = written(chosen, "labels")
    rows = features(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")).toArrow()  # sample_rows rows of hashed words
    y = rows.column("toxic").to_numpy().astype(float)

    def lists(name: str) -> list[np.ndarray]:
        return [c.values[c.offsets[k].as_py() : c.offsets[k + 1].as_py()].to_numpy() for c in rows.column(name).chunks for k in range(len(c))]

    texts, swaps = lists("ids"), lists("swaps")
    order = sorted(range(len(texts)), key=lambda k: (texts[k].tobytes(), y[k], swaps[k].tobytes()))
    flat = lambda x: (np.concatenate([np.zeros(0, np.int32), *(x[k] for k in order)]), np.array([len(x[k]) for k in order], np.int64))
    return fit(*flat(texts), y[order], *flat(swaps))


def score(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of ``docs``.

    A null or empty text scores as a text without words. Without labels of both kinds the score is the smoothed base
    rate. Repeated rows score alike; labels, lang, source and doc_id don't enter the score; other columns are ignored.
    """
    w, b = train(docs, labels, sample_rows)
    at = np.flatnonzero(w)
    model = docs.sparkSession.sparkContext.broadcast((dict(zip(at.tolist(), w[at].tolist())), b))  # BUCKETS weights at most
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model.value
        of = Cache(lambda word: tuple(k for k in buckets(word) if k in weights))
        for batch in batches:
            out = []
            for t in batch.column(1).to_pylist():
                hits = set().union(*map(of.__getitem__, set(WORDS.findall((t or "").lower()))))
                out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, bias + math.fsum(map(weights.get, hits)))))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
