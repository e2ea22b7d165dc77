"""Benchmark decontamination by size-partitioned MinHash containment search, in DataFrame functions only.

Documents are cut into segments of at most SEGMENT shingles (five words), so that a short item is never lost in a long
text. Segments and items get MinHash signatures of one shared family: a shingle's hash is put through an exclusive or
with each of the seeds, and the least value is kept. Items are partitioned by size: the smaller an item is beside a
segment, the more places of the signature its partition compares; one equal place makes a candidate. The smallest
items (fewer than TINY shingles) are held against segments with their whole shingle set. Candidates are verified by
exact containment of the item's shingles in the whole document.

Places can only agree on a shingle that the item's signature holds, so segments without any such shingle are left out
before signatures are made; that loses no candidate and spares nearly all of the work.

A segment with a part h of an item of s shingles agrees at a place with probability h / (SEGMENT + s - h) at least; an
item that straddles two segments has two chances at every place. At containment 0.8 and an even split the chance to
find nothing is (1 - 9.6 / 142.4) ** 256 = 2e-8 for s = 24 and (1 - 19.2 / 156.8) ** 128 = 6e-8 for s = 48.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checked_broadcast, written

WORDS = 5
SEGMENT = 128
TINY = 24
#: (fewest shingles of an item, places compared): the size partitions above the smallest.
PARTITIONS = ((TINY, 128), (48, 64))
THRESHOLD = 0.8


def words_of(text: Column) -> Column:
    """Lower-case words between ASCII blanks; none of a null text."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingle_strings(words: Column) -> Column:
    """All five-word shingles, as strings."""
    n = F.size(words) - F.lit(WORDS - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.array_join(F.slice(words, i, WORDS), " "))).otherwise(
        F.array().cast("array<string>")
    )


def exploded(rows: DataFrame, keys: list[str], words: str) -> DataFrame:
    """A row for each shingle: keys, segment and h, a hash of its words. Texts of fewer words give none."""
    n = F.greatest(F.size(words) - F.lit(WORDS - 1), F.lit(0))
    zipped = F.arrays_zip(*[F.slice(F.col(words), F.lit(k + 1), n).alias(f"w{k}") for k in range(WORDS)])
    return rows.select(*keys, F.posexplode(zipped).alias("at", "z")).select(
        *keys, F.expr(f"at div {SEGMENT}").alias("segment"), F.xxhash64(*[F.col("z").getField(f"w{k}") for k in range(WORDS)]).alias("h")
    )


def places() -> int:
    return max(p for _, p in PARTITIONS)


def seed(k: int) -> int:
    """The k-th random point (splitmix64), as a signed long."""
    z = (k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
    z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
    z = (z ^ z >> 27) * 0x94D049BB133111EB & (1 << 64) - 1
    z ^= z >> 31
    return z - (1 << 64) if z >> 63 else z


def signatures(hashes: DataFrame, keys: list[str]) -> DataFrame:
    """The MinHash signature of each group of ``keys`` over its rows' h, as columns m0, m1, ..."""
    return hashes.groupBy(*keys).agg(*[F.min(F.col("h").bitwiseXOR(F.lit(seed(k)))).alias(f"m{k}") for k in range(places())])


def long_form(signed: DataFrame, keys: list[str]) -> DataFrame:
    return signed.select(*keys, F.posexplode(F.array(*[f"m{k}" for k in range(places())])).alias("place", "least"))


def contaminated(docs: DataFrame, bench: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared) of documents that hold ``threshold`` or more of an item's distinct shingles.

    docs: doc_id, text; bench: item_id, text. Items of fewer than five words have no shingles and are never found.
    Null and empty texts hold nothing. Rows without doc_id or item_id are left out, as no result could name them.
    Repeated rows give one result. Empty tables give none. Other columns are ignored, whatever their names.
    """
    b = bench.filter("item_id IS NOT NULL").select("item_id", words_of(F.col("text")).alias("w"))
    items = written(b.select("item_id", F.array_distinct(shingle_strings(F.col("w"))).alias("shingles"), "w").filter(F.size("shingles") > 0).distinct(), "bench")
    # an item_id with several texts: each text is an item of its own
    items = items.withColumn("item", F.xxhash64("item_id", "w"))
    hashes = exploded(items.withColumn("n", F.size("shingles")), ["item", "n"], "w")
    tiny = hashes.filter(F.col("n") < TINY).select("item", F.lit(-1).alias("place"), F.col("h").alias("least"), "h").distinct()
    compared = F.coalesce(*[F.when(F.col("n") >= least, F.lit(k)) for least, k in reversed(PARTITIONS)])
    seeds = F.array(*[F.lit(seed(k)) for k in range(places())])
    signed = (
        long_form(signatures(hashes.filter(F.col("n") >= TINY), ["item", "n"]), ["item", "n"])
        .filter(F.col("place") < compared)
        .select("item", "place", "least", F.col("least").bitwiseXOR(F.element_at(seeds, F.col("place") + 1)).alias("h"))
    )
    index = written(tiny.unionByName(signed), "bench-signatures")
    wanted = written(index.select("h").distinct(), "bench-shingles")

    d = docs.filter("doc_id IS NOT NULL").select("doc_id", words_of(F.col("text")).alias("w"))
    hit = exploded(d, ["doc_id"], "w").join(checked_broadcast(wanted), "h").select("doc_id", "segment").distinct()
    hit = written(hit, "segments")
    hit_docs = checked_broadcast(written(hit.select("doc_id").distinct(), "segment-docs"))
    held = written(d.join(hit_docs, "doc_id", "left_semi").distinct().withColumn("body", F.xxhash64("doc_id", "w")), "hit-docs")
    parts = exploded(held, ["doc_id", "body"], "w").join(hit, ["doc_id", "segment"], "left_semi").drop("doc_id")
    by_place = long_form(signatures(parts, ["body", "segment"]), ["body"])
    small = parts.select("body", F.lit(-1).alias("place"), F.col("h").alias("least"))
    found = by_place.unionByName(small).join(checked_broadcast(index.select("item", "place", "least")), ["place", "least"]).select("body", "item").distinct()
    pairs = found.join(held.select("body", "doc_id", "w"), "body").join(items.select("item", "item_id", "shingles"), "item")
    shared = F.size(F.array_intersect("shingles", shingle_strings(F.col("w"))))
    total = F.size("shingles")
    return (
        pairs.select("doc_id", "item_id", total.cast("long").alias("n_item"), shared.cast("long").alias("n_shared"))
        .filter(F.col("n_shared") * 1000 >= F.col("n_item") * round(threshold * 1000))
        .groupBy("doc_id", "item_id").agg(F.max_by(F.struct("n_item", "n_shared"), F.struct(F.col("n_shared") / F.col("n_item"), "n_item")).alias("m"))
        .select("doc_id", "item_id", "m.n_item", "m.n_shared")
    )


def clean(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """Rows of ``docs`` without contamination, all their columns kept."""
    bad = written(contaminated(docs, bench).select("doc_id").distinct(), "contaminated")
    return docs.join(checked_broadcast(bad), "doc_id", "left_anti").select(docs.columns)


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM d WHERE len(w) > 4),
bs AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM b WHERE len(w) > 4),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id)
SELECT doc_id, item_id, n_item, count(*) AS n_shared FROM ds JOIN bs USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING count(*) * 10 >= n_item * 8
"""
