"""Suffix-array dedup of byte strings, by deep-shallow sorting.

Every 200-byte window has an anchor (see ``anchors``), and equal windows have equal anchor grams. Around an anchor gram
that occurs twice or more, the distinct texts (chunks) are put into two suffix arrays: of what follows from the anchor
on, and of what stands before it, read backwards. A window that begins o bytes before its anchor occurs again if
another chunk agrees with its own for o bytes backwards and 200 - o forwards; both are read off the arrays' common
prefix lengths. Chunks that occur as a whole twice or more are found by their hashes and counted, not sorted again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .anchors import Chunks, U, bits_of, chunks, passes, sketch
from .common import checked_broadcast, small_batches, written
from .deep_shallow import suffix_sort

SPAN, GRAM = 200, 32
#: Distinct chunks of one anchor gram that a task sorts at most; the windows of more are spread by their hashes.
HOT = 4096
#: Chunks that a sorting task gets, on average.
TASK_ROWS = 20_000


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]


def _found(batch: pa.RecordBatch) -> Iterator[Chunks]:
    return chunks(((i, np.frombuffer(t, np.uint8)) for i, t in enumerate(_texts(batch))), SPAN, GRAM)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(U, copy=False).view(np.int64), pa.int64())


def _pieces(c: Chunks) -> list[bytes]:
    raw = c.units.tobytes()
    return [raw[a : a + n + SPAN - 1] for a, n in zip(c.at.tolist(), c.n.tolist())]


def _whole(c: Chunks, pieces: list[bytes]) -> np.ndarray:
    """The identity of a chunk: its bytes and its anchor's place."""
    return np.array([xxhash.xxh3_64_intdigest(p, o) for p, o in zip(pieces, c.off.tolist())], U)


def repeated_windows(pieces: list[bytes], off: np.ndarray, n: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Which windows of distinct chunks occur twice or more: (chunk, window) booleans. A chunk counts ``count`` times."""
    most = SPAN - GRAM + 1
    out = np.zeros((len(pieces), most), bool)
    ahead, ahead_lcp = suffix_sort([p[o:] for p, o in zip(pieces, off.tolist())])
    back, back_lcp = suffix_sort([p[:o][::-1] for p, o in zip(pieces, off.tolist())])
    f, b = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
    for o in range(most):
        own = np.flatnonzero((off - n < o) & (o <= off))
        if not len(own):
            continue
        f[ahead] = np.cumsum(ahead_lcp < SPAN - o)
        b[back] = np.cumsum(back_lcp < o)
        _, klass = np.unique(f[own] * (len(pieces) + 1) + b[own], return_inverse=True)
        out[own, off[own] - o] = np.bincount(klass, count[own])[klass] > 1
    return out


def resolve(distinct: DataFrame) -> DataFrame:
    """(key, whole, mask): of distinct chunks (key, whole, c, chunk, off, n) of one or more keys, which windows are repeated, as packed bits."""
    rows = distinct.count()
    sizes = written(distinct.groupBy("key").count().filter(F.col("count") > HOT).select("key"), "hot-keys")
    hot = checked_broadcast(sizes)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        pieces = t.column("chunk").to_pylist()
        off, n, count = (t.column(x).to_numpy().astype(np.int64) for x in ("off", "n", "c"))
        mask = np.packbits(repeated_windows(pieces, off, n, count), axis=1)
        for b in pa.table({"key": t.column("key"), "whole": t.column("whole"), "mask": pa.array([m.tobytes() for m in mask], pa.binary())}).to_batches(2000):
            yield b

    parts = max(1, -(-rows // TASK_ROWS))
    sorted_ = distinct.join(hot, "key", "left_anti").repartition(parts, "key").mapInArrow(sort, "key long, whole long, mask binary")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "whole", "c", "off", "k", "h1", "h2"]
        for b in batches:
            pieces, off, n = b.column(3).to_pylist(), b.column(4).to_pylist(), b.column(5).to_pylist()
            for a in range(0, len(pieces), 100):
                row, k, h = [], [], []
                for i in range(a, min(a + 100, len(pieces))):
                    for w in range(n[i]):
                        row.append(i)
                        k.append(w)
                        h.append(xxhash.xxh3_128_intdigest(pieces[i][w : w + SPAN], off[i] - w))
                at = pa.array(row, pa.int64())
                low = np.array([x & (1 << 64) - 1 for x in h], U)
                high = np.array([x >> 64 for x in h], U)
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), b.column(2).take(at), pa.array([off[i] for i in row], pa.int32()), pa.array(k, pa.int32()), _long(low), _long(high)], names=names)

    each = written(
        distinct.join(hot, "key", "left_semi").select("key", "whole", "c", "chunk", "off", "n").mapInArrow(spread, "key long, whole long, c long, off int, k int, h1 long, h2 long"),
        "hot-windows",
    )
    again = each.groupBy("key", "h1", "h2").agg(F.sum("c").alias("s")).filter("s > 1")
    most = SPAN - GRAM + 1

    def pack(ks: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.array_contains(ks, i))

    found = each.join(again, ["key", "h1", "h2"], "left_semi").groupBy("key", "whole").agg(F.collect_list("k").alias("ks"))
    bits = F.rpad(F.array_join(F.transform(pack(F.col("ks")), lambda x: F.when(x, "1").otherwise("0")), ""), -(-most // 8) * 8, "0")
    spelled = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(-(-most // 8) - 1)), lambda i: F.lpad(F.conv(bits.substr(i * 8 + 1, F.lit(8)), 2, 16), 2, "0")), "")
    return sorted_.unionByName(found.select("key", "whole", F.unhex(spelled).alias("mask")))


def deduplicate(docs: DataFrame) -> DataFrame:
    """Of each row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (binary).

    A byte goes if a SPAN-byte string that covers it also starts anywhere else, in the same row too. Strings are
    judged on the input; matches never cross rows. Null and empty texts have no bytes. Rows that are equal repeat one
    another, whatever their doc_ids, null ones included. Other columns are ignored, whatever their names. Whole chunks
    are told apart by two 64-bit hashes, of the anchor gram and of the bytes.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    body = F.hash("text").alias("body")  # tells rows of one doc_id apart
    rows = docs.select("doc_id", "text")
    full = rows.filter(F.octet_length("text") >= SPAN)

    bits = spark.sparkContext.broadcast(sketch(full.select("text"), lambda b: (c.key for c in _found(b))))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in _found(b):
                c = c.take(passes(c.key, bits.value))
                row = pa.array(c.row)
                yield pa.RecordBatch.from_arrays(
                    [_long(c.key), _long(_whole(c, _pieces(c))), b.column(0).take(row), b.column(1).take(row), pa.array(c.start, pa.int32()), pa.array(c.n, pa.int16())],
                    names=["key", "whole", "doc_id", "body", "start", "n"],
                )

    repeated = written(full.select("doc_id", body, "text").mapInArrow(second, f"key long, whole long, doc_id {kind}, body int, start int, n short"), "chunks")
    keys = written(repeated.groupBy("key").agg(F.count("*").alias("c"), F.min("whole").alias("whole"), F.max("whole").alias("last")).filter("c > 1"), "chunk-keys")
    mixed = keys.filter("whole <> last").select("key")
    mixed_bits = spark.sparkContext.broadcast(bits_of(mixed))

    def third(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in _found(b):
                c = c.take(passes(c.key, bits.value))
                c = c.take(passes(c.key, mixed_bits.value))
                pieces = _pieces(c)
                yield pa.RecordBatch.from_arrays([_long(c.key), _long(_whole(c, pieces)), pa.array(pieces, pa.binary()), pa.array(c.off, pa.int32()), pa.array(c.n, pa.int32())], names=["key", "whole", "chunk", "off", "n"])

    one = F.any_value(F.struct("chunk", "off", "n")).alias("x")
    distinct = full.select("text").mapInArrow(third, "key long, whole long, chunk binary, off int, n int").groupBy("key", "whole").agg(F.count("*").alias("c"), one)
    distinct = written(distinct.join(mixed, "key", "left_semi").select("key", "whole", "c", "x.chunk", "x.off", "x.n"), "distinct-chunks")
    verdict = keys.filter("whole = last").select("key", "whole", F.lit(None).cast("binary").alias("mask")).unionByName(resolve(distinct).filter(F.hex("mask").rlike("[^0]")))
    gone = written(
        repeated.join(verdict, ["key", "whole"])
        .groupBy(F.col("doc_id").alias("id"), F.col("body").alias("b"))
        .agg(F.collect_list(F.struct("start", "n", F.coalesce("mask", F.lit(b"")).alias("mask"))).alias("runs")),
        "gone",
    )

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        for b in batches:
            out = []
            for text, runs in zip(_texts(b), b.column(2).to_pylist()):
                kept, spans = text, 0
                if runs:
                    hit = covered(len(text), runs)
                    kept = np.frombuffer(text, np.uint8)[~hit].tobytes()
                    spans = int(np.count_nonzero(np.diff(hit.astype(np.int8), prepend=0) == 1))
                out.append((len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.binary())], names=names)

    joined = rows.withColumn("body", body).join(gone, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("body") == F.col("b")), "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(last, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def covered(n: int, runs: list[dict]) -> np.ndarray:
    """Which of n bytes lie in a repeated window: runs of (start, n, mask), an empty mask for all of a run's windows."""
    edge = np.zeros(n + 1, np.int32)
    for r in runs:
        if not r["mask"]:
            edge[r["start"]] += 1
            edge[r["start"] + r["n"] - 1 + SPAN] -= 1
        else:
            k = np.flatnonzero(np.unpackbits(np.frombuffer(r["mask"], np.uint8))[: r["n"]]) + r["start"]
            np.add.at(edge, k, 1)
            np.add.at(edge, k + SPAN, -1)
    return np.cumsum(edge[:n]) > 0
