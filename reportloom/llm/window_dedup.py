"""Substring dedup over windows of 13 words, with a count-min prefilter.

First pass: each partition counts its windows' anchor grams in a sketch; the merged sketch overestimates how often a
window occurs. Second pass: only windows that it estimates repeated are grouped, and exactly: first whole chunks (runs
of windows with one anchor), then, where an anchor gram has several chunks, window by window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import BASE, Chunks, U, bits_of, chunks, grams, mix, passes, sketch
from .common import WORD, small_batches, written

SPAN, GRAM = 13, 6
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of a text that are hashed together.
SLICE = 1 << 22


def word_hashes(text: str | None) -> np.ndarray:
    """A hash of each word (a run of other bytes than the six blanks, which no letter's UTF-8 holds)."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    out, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + SLICE)
        if end < len(raw):  # cut at a blank, if there is one
            back = np.flatnonzero(BLANK[raw[at:end]])
            after = np.flatnonzero(BLANK[raw[end:]]) if not len(back) else back
            end = at + int(back[-1]) + 1 if len(back) else end + int(after[0]) if len(after) else len(raw)
        out.append(_word_hashes(raw[at:end]))
        at = end
    return np.concatenate(out) if out else np.zeros(0, U)


def _word_hashes(raw: np.ndarray) -> np.ndarray:
    inside = np.flatnonzero(~BLANK[raw])
    if not len(inside):
        return np.zeros(0, U)
    first = np.append(True, np.diff(inside) > 1)
    starts = np.flatnonzero(first)
    lens = np.diff(np.append(starts, len(inside)))
    place = np.arange(len(inside)) - np.repeat(starts, lens)
    power = np.cumprod(np.full(int(lens.max()), U(BASE)))
    sums = np.add.reduceat((raw[inside].astype(U) + U(1)) * power[place], starts)
    return mix(sums ^ (lens.astype(U) << U(48)))


def _found(batch: pa.RecordBatch) -> Iterator[Chunks]:
    return chunks(((i, word_hashes(t)) for i, t in enumerate(batch.column(batch.schema.get_field_index("text")).to_pylist())), SPAN, GRAM)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(U, copy=False).view(np.int64), pa.int64())


def _whole(c: Chunks, windows: np.ndarray) -> np.ndarray:
    """The identity of a chunk: its first and last window (which overlap), its length and its anchor's place."""
    return mix(windows[c.at] * U(3) + windows[c.at + c.n - 1] * U(0xD6E8FEB86659FD93) + c.n.astype(U) * U(31) + c.off.astype(U))


def deduplicate(docs: DataFrame) -> DataFrame:
    """Of each row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_sha256 and kept_text.

    A word goes if a window of SPAN words that covers it also starts in a row with a smaller doc_id. Windows are
    judged on the input. Null and empty texts have no words. Equal doc_ids aren't smaller than one another, so rows
    that repeat a doc_id don't touch each other. A row without doc_id removes nothing and loses nothing. Other columns
    are ignored, whatever their names. Windows are told apart by two 64-bit hashes, of the anchor gram and the whole.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select("doc_id", "text")
    body = F.hash("text").alias("body")  # tells rows of one doc_id apart
    named = rows.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    kind = docs.schema["doc_id"].dataType.simpleString()

    bits = spark.sparkContext.broadcast(sketch(named.select("text"), lambda b: (c.key for c in _found(b))))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in _found(b):
                windows = grams(c.units, SPAN)
                c = c.take(passes(c.key, bits.value))
                row = pa.array(c.row)
                yield pa.RecordBatch.from_arrays(
                    [_long(c.key), _long(_whole(c, windows)), b.column(0).take(row), b.column(1).take(row), pa.array(c.start, pa.int32()), pa.array(c.n, pa.int8())],
                    names=["key", "whole", "doc_id", "body", "start", "n"],
                )

    repeated = written(named.select("doc_id", body, "text").mapInArrow(second, f"key long, whole long, doc_id {kind}, body int, start int, n byte"), "chunks")
    keys = written(
        repeated.groupBy("key").agg(F.count("*").alias("c"), F.min("whole").alias("whole"), F.max("whole").alias("last"), F.min("doc_id").alias("first_id")).filter("c > 1"),
        "chunk-keys",
    )
    pure = keys.filter("whole = last").select("key", "whole", "first_id", F.lit(0).alias("mask"))
    mixed = keys.filter("whole <> last").select("key")
    mixed_bits = spark.sparkContext.broadcast(bits_of(mixed))

    def third(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in _found(b):
                windows = grams(c.units, SPAN)
                c = c.take(passes(c.key, bits.value))
                c = c.take(passes(c.key, mixed_bits.value))
                ends = np.append(0, np.cumsum(c.n))
                each = np.arange(ends[-1]) - np.repeat(ends[:-1] - c.at, c.n)
                yield pa.RecordBatch.from_arrays(
                    [_long(c.key), _long(_whole(c, windows)), b.column(0).take(pa.array(c.row)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _long(mix(windows[each])))],
                    names=["key", "whole", "doc_id", "windows"],
                )

    each = (
        named.select("doc_id", "text").mapInArrow(third, f"key long, whole long, doc_id {kind}, windows array<long>")
        .groupBy("key", "whole").agg(F.min("doc_id").alias("first_id"), F.any_value("windows").alias("windows"))
    )
    each = written(each.join(mixed, "key", "left_semi").select("key", "whole", "first_id", F.posexplode("windows").alias("k", "window")), "windows")
    firsts = each.groupBy("key", "window").agg(F.min("first_id").alias("least_id"))
    masks = (
        each.join(firsts, ["key", "window"])
        .groupBy("key", "whole").agg(F.first("first_id").alias("first_id"), F.sum(F.when(F.col("least_id") < F.col("first_id"), F.expr("shiftleft(1, k)")).otherwise(0)).cast("int").alias("mask"))
    )
    verdict = pure.unionByName(masks)
    full = F.expr("shiftleft(1, cast(n AS int)) - 1")
    gone = (
        repeated.join(verdict, ["key", "whole"])
        .select("doc_id", "body", "start", F.when(F.col("doc_id") > F.col("first_id"), full).otherwise(F.col("mask")).alias("bits"))
        .filter("bits <> 0")
        .groupBy(F.col("doc_id").alias("id"), F.col("body").alias("b")).agg(F.collect_list("start").alias("starts"), F.collect_list("bits").alias("bits"))
    )
    gone = written(gone, "gone")

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, removed, sha, kept_text = [], [], [], []
            for text, starts, masks_ in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                words = WORD.findall(text or "")
                kept = words
                if starts:
                    kept = np.array(words, object)[~covered(len(words), np.array(starts), np.array(masks_))].tolist()
                line = " ".join(kept)
                n.append(len(words))
                removed.append(len(words) - len(kept))
                sha.append(hashlib.sha256(line.encode("utf-8", "surrogatepass")).hexdigest())
                kept_text.append(line)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(kept_text, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    joined = rows.withColumn("body", body).join(gone, (F.col("doc_id") == F.col("id")) & (F.col("body") == F.col("b")), "left").select("doc_id", "text", "starts", "bits")
    return joined.mapInArrow(last, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string")


def covered(n: int, starts: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Which of n words lie in a window that starts at starts[i] + k for a set bit k of masks[i]."""
    edge = np.zeros(n + 1, np.int32)
    for k in range(SPAN):
        at = starts[masks >> k & 1 == 1] + k
        np.add.at(edge, at, 1)
        np.add.at(edge, np.minimum(at + SPAN, n), -1)
    return np.cumsum(edge[:n]) > 0
