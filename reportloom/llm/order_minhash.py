"""Near-duplicates by order MinHash and banded alignment.

A text's k-mers are its shingles of five words, and those of three, labelled with how often they have occurred so far.
Each of the hash functions picks the two least labelled k-mers of a length and keeps them in text order: a sketch that
two texts share the more likely the smaller their edit distance is. Texts that share a sketch meet in a bucket; there
each is held against the least text and, where that leaves a bucket unconnected, against the greatest; buckets of five-word
shingles come first. What is still unconnected in a bucket (unlike texts with a common passage, say) is held against
each other in blocks: word counts in BINS bins give a lower bound of the edits, and pairs that it doesn't rule out become
candidates, in the first of the buckets that they share. So no pair of a bucket is skipped. A candidate is verified by alignment of the words within a diagonal band:
similarity is 1 - edits / words of the longer text.

Two texts of shingle similarity j share a sketch of one length with probability of about j * j. Every fifth word
substituted (the most that counts) leaves no shingle of five words and j = 0.25 of those of three: none of 72 with
probability of about 0.008. README gives the measured recall. Texts are named by a 64-bit hash and words in alignments
by 32 bits of theirs: among ten billion texts some three pairs are expected to share a name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import BASE, U, bits_of, grams, mix, passes
from .common import checked_broadcast, forget, salted_join, small_batches, written
from .links import components
from .window_dedup import word_hashes

#: Words of a shingle, and sketches of that kind: five words tell texts apart, three survive edits spread over a text.
SHINGLES = ((5, 24), (3, 72))
KEYS = sum(n for _, n in SHINGLES)
#: Bins of a text's word counts (every COARSE of them are added up for a first look), and members of a bucket that are held against each other at a time.
BINS, COARSE, BLOCK = 1024, 4, 1024
THRESHOLD = 0.8
#: Words of a text up to which an alignment holds a mask of the whole text for each word.
SHORT = 8192
_SEEDS = mix(np.arange(1, KEYS + 1, dtype=U) * U(BASE))
#: Bits of a position in a packed (hash, position) value.
_LOW = U((1 << 24) - 1)
_MAX = U((1 << 64) - 1)


def _words(text: str | None) -> np.ndarray:
    return word_hashes((text or "").lower())


def labelled(shingles: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Shingle hashes with their occurrence's number mixed in; ``doc`` rises and parts the texts."""
    order = np.lexsort((shingles, doc))
    s, d = shingles[order], doc[order]
    new = np.append(True, (s[1:] != s[:-1]) | (d[1:] != d[:-1]))
    starts = np.flatnonzero(new)
    nth = np.empty(len(s), U)
    nth[order] = np.arange(len(s), dtype=U) - np.repeat(starts, np.diff(np.append(starts, len(s)))).astype(U)
    return mix(shingles + nth * U(0xD6E8FEB86659FD93))


def sketches(texts: list[np.ndarray]) -> np.ndarray:
    """The keys of each text's buckets (texts: arrays of word hashes, none empty): a row of KEYS for each."""
    ends = np.cumsum([n for _, n in SHINGLES])
    return np.concatenate([_sketches(texts, k, _SEEDS[end - n : end]) for (k, n), end in zip(SHINGLES, ends)], axis=1)


def _sketches(texts: list[np.ndarray], shingle: int, seeds: np.ndarray) -> np.ndarray:
    own = [grams(w, min(shingle, len(w))) for w in texts]
    lens = np.array([len(o) for o in own])
    starts = np.cumsum(lens) - lens
    label = labelled(np.concatenate(own), np.repeat(np.arange(len(own)), lens))
    spot = np.arange(len(label), dtype=U)
    out = np.empty((len(own), len(seeds)), U)
    for k, seed in enumerate(seeds):
        v = (label ^ seed) & ~_LOW
        if len(label) <= int(_LOW):
            v |= spot
            one = (np.minimum.reduceat(v, starts) & _LOW).astype(np.int64)
            v[one] = _MAX
            two = (np.minimum.reduceat(v, starts) & _LOW).astype(np.int64)
        else:  # positions don't fit beside the hash: text by text, the first place of equals as above
            one = np.array([a + np.argmin(v[a : a + n]) for a, n in zip(starts, lens)])
            v[one] = _MAX
            two = np.array([a + np.argmin(v[a : a + n]) for a, n in zip(starts, lens)])
        two = np.where(lens > 1, two, one)
        out[:, k] = mix(label[np.minimum(one, two)] * U(3) + mix(label[np.maximum(one, two)]) + seed)
    return out


def binned(words: np.ndarray) -> bytes:
    """Counts of a text's words in BINS bins, 255 at most: an edit changes one count, or two by one each."""
    return np.minimum(np.bincount((words % BINS).astype(np.int64), minlength=BINS), 255).astype(np.uint8).tobytes()


def open_pairs(n: np.ndarray, comp: np.ndarray, side: np.ndarray, bins: np.ndarray, across: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of different components (``across``: and sides) that neither lengths nor binned counts show to be unlike."""
    order = np.argsort(n, kind="stable")
    n, comp, side, bins = n[order], comp[order], side[order], bins[order].astype(np.int16)
    coarse = bins.reshape(len(bins), -1, COARSE).sum(2, dtype=np.int16)
    ends = np.searchsorted(n, (n + 1e-9) / threshold, "right") if threshold > 0 else np.full(len(n), len(n))
    most = ((1 - threshold) * n + 1e-9).astype(np.int64)
    left, right = [], []
    for i in range(len(n) - 1):
        j = np.arange(i + 1, max(i + 1, ends[i]))
        j = j[(comp[j] != comp[i]) & (side[j] != side[i])] if across else j[comp[j] != comp[i]]
        for counts in (coarse, bins):
            if len(j):
                more = counts[j] - counts[i]
                up = np.maximum(more, 0).sum(1, dtype=np.int64)
                j = j[np.maximum(up, up - more.sum(1, dtype=np.int64)) <= most[j]]
        left.append(np.full(len(j), order[i]))
        right.append(order[j])
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def first_shared(keys: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of each pair (i, j) of rows of ``keys`` the first place where they agree."""
    parts = [(keys[i[a : a + 10_000]] == keys[j[a : a + 10_000]]).argmax(1) for a in range(0, len(i), 10_000)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def within(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """The edit distance of two arrays if it is at most ``most``, else None."""
    if abs(len(a) - len(b)) > most:
        return None
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[::-1][:n] != b[::-1][:n])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not len(a) or not len(b):
        d = max(len(a), len(b))
        return d if d <= most else None
    # words that one side has more often than the other: none can be matched
    values, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    left = np.bincount(where[: len(a)], minlength=len(values))
    right = np.bincount(where[len(a) :], minlength=len(values))
    if max(len(a), len(b)) - int(np.minimum(left, right).sum()) > most:
        return None
    return _band(a, b, most)


def _spots(a: np.ndarray, reach: int):
    """A function (word, j) -> which of the 2 * reach + 1 words of ``a`` around its j-th are that word, as bits."""
    width = 2 * reach + 1
    if len(a) <= SHORT:
        bits: dict[int, int] = {}
        for i, w in enumerate(a.tolist(), reach):
            bits[w] = bits.get(w, 0) | 1 << i
        mask = (1 << width) - 1
        return lambda w, j: bits.get(w, 0) >> j & mask
    # whole masks of each word would grow with the square of the text: positions, and a window's bits when needed
    order = np.argsort(a, kind="stable")
    values, starts = np.unique(a[order], return_index=True)
    places = dict(zip(values.tolist(), np.split(order, starts[1:])))

    def window(w: int, j: int) -> int:
        p = places.get(w)
        if p is None:
            return 0
        p = p[np.searchsorted(p, j - reach) : np.searchsorted(p, j + reach + 1)] - (j - reach)
        flags = np.zeros(width, bool)
        flags[p] = True
        return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")

    return window


def _band(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """Edit distance, if at most ``most``, over a band of ``most`` diagonals to either side; a column is a few operations on long integers.

    Bit k of a column stands for its k-th diagonal: up and down say where a value differs by +1 or -1 from the one
    above it (already moved to the next column's rows), stay where it equals the one before it on its diagonal. The
    distance is followed along the last cell's diagonal, where it never falls.
    """
    mask = (1 << (2 * most + 1)) - 1
    spot = _spots(a, most)
    up, down = mask >> most << most, 0
    last = 1 << (len(a) - len(b) + most)
    d = max(len(a) - len(b), 0)
    for j, word in enumerate(b.tolist()):
        same = spot(word, j)
        stay = (((same & up) + up ^ up) | same | down) & mask
        right = down | mask ^ (stay | up)
        left = stay & up
        if not stay & last:
            d += 1
            if d > most:
                return None
        up = left | mask ^ (stay >> 1 | right)
        down = stay >> 1 & right
    return d


def at_most(a: np.ndarray, b: np.ndarray) -> int:
    """An upper bound of the edit distance: an alignment through word pairs that both sides have once, in one order."""
    n = max(len(a), len(b))
    if min(len(a), len(b)) < 2:
        return n
    pair = lambda w: w[:-1].astype(np.int64) * 0x9E3779B1 + w[1:]
    (p, i, pc), (q, j, qc) = (np.unique(pair(w), return_index=True, return_counts=True) for w in (a, b))
    _, x, y = np.intersect1d(p[pc == 1], q[qc == 1], assume_unique=True, return_indices=True)
    i, j = i[pc == 1][x], j[qc == 1][y]
    order = np.argsort(i)
    i, j = i[order], j[order]
    fit = (j == np.maximum.accumulate(j)) & (j == np.minimum.accumulate(j[::-1])[::-1])
    fit &= a[i] == b[j]
    i, j = np.concatenate([[-1], i[fit], [len(a)]]), np.concatenate([[-1], j[fit], [len(b)]])
    return int(np.maximum(np.diff(i), np.diff(j)).sum() - (len(i) - 1))


def similar(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> bool:
    """Whether the distance is in the band; a plain upper bound settles most copies without an alignment."""
    most = int((1 - threshold) * max(len(a), len(b)) + 1e-9)
    return abs(len(a) - len(b)) <= most and (at_most(a, b) <= most or within(a, b, most) is not None)


def _longs(x) -> pa.Array:
    return pa.array(np.asarray(x, U).view(np.int64), pa.int64())


def linked(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, body, n, c, class_id, n_links) of each row of ``docs`` (doc_id, text): body tells a doc_id's texts apart, n is the number of words, c names the class."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [_words(t) for t in b.column(1).to_pylist()]
            some = [i for i, w in enumerate(words) if len(w)]
            out, at = np.zeros((len(words), KEYS), U), 0
            while at < len(some):  # about a quarter of a million words at a time
                end, size = at, 0
                while end < len(some) and (end == at or size + len(words[some[end]]) < 250_000):
                    size += len(words[some[end]])
                    end += 1
                out[some[at:end]] = sketches([words[i] for i in some[at:end]])
                at = end
            names = [xxhash.xxh3_64_intdigest(w.tobytes()) for w in words]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1) * KEYS, pa.int32()), _longs(out.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), _longs(names), pa.array([len(w) for w in words], pa.int32()), lists], names=["doc_id", "body", "t", "n", "sketches"])

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("body"))
    base = written(rows.mapInArrow(sketched, f"doc_id {kind}, body long, t long, n int, sketches array<long>"), "sketches")
    texts = written(base.filter("n > 0").groupBy("t").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketches").alias("sketches")), "texts")
    wide, base = base, written(base.drop("sketches"), "rows")
    forget(wide)
    some = base.filter("n > 0")
    shared = written(texts.select(F.explode("sketches").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("c")).filter("c > 1").select("bucket"), "buckets")
    # most keys are in one text only: a filter of fixed size that passes all the others spares their way to the join
    bits = spark.sparkContext.broadcast(bits_of(shared))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(2).flatten().to_numpy().view(U)
            at = np.flatnonzero(passes(keys, bits.value))
            row = pa.array(at // KEYS)
            yield pa.RecordBatch.from_arrays([_longs(keys[at]), pa.array(at % KEYS, pa.int32()), b.column(0).take(row), b.column(1).take(row)], names=["bucket", "k", "t", "n"])

    members = written(texts.select("t", "n", "sketches").mapInArrow(dealt, "bucket long, k int, t long, n int").join(shared, "bucket"), "members")
    forget(shared)

    # words of the texts that have company
    company = members.select("t").distinct().join(texts.select("t", "rep"), "t")
    reps = checked_broadcast(written(company.select(F.col("rep").alias("doc_id")).distinct(), "reps"))

    def worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [_words(t) for t in b.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, words)])
            low = np.concatenate([*words, np.zeros(0, U)]).astype(np.uint32).view(np.int32)
            names = [xxhash.xxh3_64_intdigest(w.tobytes()) for w in words]
            yield pa.RecordBatch.from_arrays([_longs(names), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(low, pa.int32())), pa.array([binned(w) for w in words], pa.binary())], names=["t", "w", "bins"])

    chosen = rows.join(reps, rows["doc_id"].eqNullSafe(reps["doc_id"]), "left_semi").select("doc_id", "text")
    words = written(chosen.mapInArrow(worded, "t long, w array<int>, bins binary").dropDuplicates(["t"]), "words")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, c = b.column(2), b.column(3)
            ok = [similar(a[i].values.to_numpy(), c[i].values.to_numpy(), threshold) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ok, pa.bool_())], names=["a", "b", "ok"])

    def check(pairs: DataFrame) -> DataFrame:
        """Verdicts on distinct ``pairs``. A pivot has as many pairs as its buckets have members, so both joins deal its pairs over salts."""
        pairs = written(pairs, "pairs")
        one = salted_join(pairs, words.select(F.col("t").alias("a"), F.col("w").alias("wa")), "a", "b")
        both = salted_join(one, words.select(F.col("t").alias("b"), F.col("w").alias("wb")), "b", "a", counted=pairs)
        return written(both.select("a", "b", "wa", "wb").mapInArrow(verified, "a long, b long, ok boolean"), "verified")

    def unconnected(rows: DataFrame, more_than: int) -> DataFrame:
        """Members of buckets that aren't connected by now, with lo and hi, the least and the greatest (t, n, comp) of the bucket."""
        own = rows.withColumn("comp", F.col("t"))
        if labels is not None:
            own = rows.join(labels.select(F.col("v").alias("t"), F.col("c").alias("l")), "t", "left").withColumn("comp", F.coalesce("l", "t"))
        own = written(own.select("bucket", "k", "t", "n", "comp"), "named-members")
        tables.append(own)
        item = F.struct("t", "n", "comp")
        apart = own.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.min(item).alias("lo"), F.max(item).alias("hi"), F.count("*").alias("c")).filter(f"x <> y AND c > {more_than}")
        return written(own.join(apart.select("bucket", "lo", "hi", "c"), "bucket"), "unconnected")

    tables = []

    def learn(pairs: DataFrame) -> None:
        nonlocal tried, labels
        pairs = pairs if tried is None else pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti")
        done = check(pairs)
        if not done.isEmpty():
            tried = done if tried is None else written(tried.unionByName(done), "tried")
            labels = written(components(tried.filter("ok")), "components")

    tried = labels = None
    five = F.col("k") < SHINGLES[0][1]
    left = members.filter(five)
    for turn, (end, more_than) in enumerate((("lo", 1), ("lo", 1), ("hi", 2))):
        left = unconnected(left, more_than)
        forget(*tables)
        tables.clear()
        near = F.least(F.col("n"), F.col(f"{end}.n")) >= F.greatest(F.col("n"), F.col(f"{end}.n")) * threshold - 1e-9
        pairs = left.filter((F.col("comp") != F.col(f"{end}.comp")) & near)
        learn(pairs.select(F.least(F.col("t"), F.col(f"{end}.t")).alias("a"), F.greatest(F.col("t"), F.col(f"{end}.t")).alias("b")).distinct())
        left = left.select("bucket", "k", "t", "n")
        if not turn:  # buckets of five-word shingles have been first; what they leave goes on with all others
            left = left.unionByName(members.filter(~five))
    # what is still apart in a bucket: each against each, BLOCK by BLOCK members
    left = unconnected(left, 2).select("bucket", "k", "t", "n", "comp", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks"))
    apart = checked_broadcast(written(left.select("t").distinct(), "apart"))
    about = texts.select("t", "sketches").join(apart, "t", "left_semi").join(words.select("t", "bins"), "t")
    mixed = left.join(about, "t")
    own = F.pmod(F.xxhash64("t"), F.col("blocks")).cast("int")
    mixed = mixed.withColumn("side", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    mixed = mixed.select("bucket", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "t", "n", "comp", "side", "k", "bins", "sketches")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(cols: list[np.ndarray], ends: np.ndarray) -> pa.RecordBatch:
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for at, end in zip(ends, ends[1:]):
                _, lo, hi, t, n, comp, side, k, bins, own = (c[at:end] for c in cols)
                i, j = open_pairs(n, comp, side, bins, bool(lo[0] != hi[0]), threshold)
                new = first_shared(own, i, j) == k[0]
                i, j = i[new], j[new]
                a.append(np.minimum(t[i], t[j]))
                b.append(np.maximum(t[i], t[j]))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:8]]
            cols.append(np.frombuffer(b"".join(batch.column(8).to_pylist()), np.uint8).reshape(-1, BINS))
            cols.append(batch.column(9).flatten().to_numpy().reshape(-1, KEYS))
            cols = [np.concatenate(x) for x in zip(rest, cols)] if rest else cols
            new = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])) + 1
            if len(new):
                yield pairs(cols, np.append(0, new))
            rest = [c[new[-1] if len(new) else 0 :] for c in cols]
        if rest:
            yield pairs(rest, np.array([0, len(rest[0])]))

    mixed = mixed.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
    learn(written(mixed.mapInArrow(compared, "a long, b long").distinct(), "open-pairs"))
    nothing = spark.createDataFrame([], "v long, c long, a long, b long, ok boolean")
    tried, labels = tried if tried is not None else nothing.select("a", "b", "ok"), labels if labels is not None else nothing.select("v", "c")
    forget(members, words, texts)
    ok = tried.filter("ok")
    degree = ok.select(F.col("a").alias("t")).union(ok.select("b")).groupBy("t").agg(F.count("*").alias("n_links"))
    ids = written(some.groupBy("t").agg(F.min("doc_id").alias("rep")).join(labels.withColumnRenamed("v", "t"), "t", "left").withColumn("c", F.coalesce("c", "t")), "texts")
    least = written(ids.groupBy("c").agg(F.min("rep").alias("class_id")), "class-ids")
    links = salted_join(ids.select("t", "c"), least, "c", "t").join(degree, "t", "left").select("t", "c", "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    named = salted_join(some.select("doc_id", "body", "t", "n"), written(links, "links"), "t", "doc_id").select("doc_id", "body", "n", "c", "class_id", "n_links")
    none = base.filter("n = 0").select("doc_id", "body", "n", F.lit(None).cast("long").alias("c"), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return named.unionByName(none)


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, n_links) for each row of ``docs`` (doc_id, text).

    Rows are linked if their words (lower case) are at least ``threshold`` (0.75 or more) similar; class_id is the least
    doc_id that a row is connected with, n_links the number of different texts that were found to be linked with the
    row's text. Rows with the same words share a class. A text without words (null, empty) is its own class. A row
    without doc_id takes part; it has a null class_id only where its class has no doc_id at all. Repeated rows, repeated
    doc_ids and ties change nothing; other columns are ignored, whatever their names. An empty table gives no rows.
    """
    return linked(docs, threshold).select("doc_id", "class_id", "n_links")


def first_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay, all columns kept: of each class one, the one with the least doc_id (rows without one last, then by a hash of the text).

    Rows are told apart by doc_id and text, so where a doc_id repeats only its copies go. Of rows that are equal in both
    one stays, whichever. Texts without words stay, all of them. An empty table gives no rows.
    """
    named = written(linked(docs, threshold).filter("n > 0").select("doc_id", "body", "c"), "named")
    order = F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "body")
    stay = named.groupBy("c").agg(F.min(order).alias("x")).select("x.doc_id", "x.body")
    groups = named.groupBy("doc_id", "body").agg(F.count("*").alias("k"))
    both = groups["doc_id"].eqNullSafe(stay["doc_id"]) & (groups["body"] == stay["body"])
    lost = checked_broadcast(written(groups.join(stay, both, "left_anti").select("doc_id", "body"), "copies"))
    again = checked_broadcast(written(groups.filter("k > 1").join(stay, both, "left_semi").select("doc_id", "body"), "repeated-rows"))
    body = "_body"
    while body in docs.columns:
        body += "_"
    marked = docs.withColumn(body, F.xxhash64("text"))
    same = lambda other: marked["doc_id"].eqNullSafe(other["doc_id"]) & (marked[body] == other["body"])
    kept = marked.join(lost, same(lost), "left_anti")
    if not again.isEmpty():
        kept = kept.join(again, same(again), "left_anti").unionByName(kept.join(again, same(again), "left_semi").dropDuplicates(["doc_id", body]))
    return kept.select(docs.columns)
