"""Sharding by best-fit-decreasing bin packing.

Rows with equal texts form a group that no shard boundary cuts. Groups are taken by falling size; each enters the
bin with the tightest remaining capacity that still holds it, found in a balanced search tree. Every group is an item
of its own, but groups of one size are alike to the packing, so the driver gets the sizes with their counts only: no
more rows than the square root of twice all bytes, as the sizes are distinct. The groups of a size are then dealt out,
in order, to the bins that the packing gave to that size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checked_broadcast, salted_join, written

#: Rows of one slot-numbering task, on average.
ROWS_PER_CHUNK = 20_000


class CapacityTree:
    """A treap of (remaining capacity, bin): insert, delete, ceiling and maximum in O(log bins)."""

    def __init__(self) -> None:
        self.root, self._state = None, 0x9E3779B9

    def _priority(self) -> int:
        self._state = (self._state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        return self._state >> 11

    @staticmethod
    def _cut(node, key):
        """Nodes below ``key``, and the others. A node is [key, priority, left, right]."""
        low_root, high_root = [None] * 4, [None] * 4
        low, high = (low_root, 3), (high_root, 2)
        while node:
            if node[0] < key:
                low[0][low[1]], low, node = node, (node, 3), node[3]
            else:
                high[0][high[1]], high, node = node, (node, 2), node[2]
        low[0][low[1]] = high[0][high[1]] = None
        return low_root[3], high_root[2]

    def insert(self, key) -> None:
        parent, side, node, p = None, 0, self.root, self._priority()
        while node and node[1] >= p:
            parent, side, node = node, 2 + (key > node[0]), node[2 + (key > node[0])]
        low, high = self._cut(node, key)
        new = [key, p, low, high]
        if parent:
            parent[side] = new
        else:
            self.root = new

    def delete(self, key) -> None:
        parent, side, node = None, 0, self.root
        while node[0] != key:
            parent, side, node = node, 2 + (key > node[0]), node[2 + (key > node[0])]
        a, b, spine = node[2], node[3], []
        while a and b:
            spine.append((a, 3) if a[1] > b[1] else (b, 2))
            a, b = (a[3], b) if a[1] > b[1] else (a, b[2])
        rest = a or b
        for x, s in reversed(spine):
            x[s], rest = rest, x
        if parent:
            parent[side] = rest
        else:
            self.root = rest

    def ceiling(self, key):
        """The least entry that isn't below ``key``."""
        found, node = None, self.root
        while node:
            if node[0] < key:
                node = node[3]
            else:
                found, node = node[0], node[2]
        return found

    def maximum(self):
        node = self.root
        while node and node[3]:
            node = node[3]
        return node and node[0]


def best_fit_decreasing(items: list[tuple], capacity: int, bins: int | None = None) -> list[int]:
    """The bin of each (size, name) item.

    With ``bins``, there are that many from the start and an item that fits none enters the emptiest, which then
    exceeds ``capacity``. Without, a bin is opened when nothing fits, so bins of fixed capacity are kept few; an item
    above ``capacity`` gets a bin of its own. Ties of size go by name, ties of capacity to the lower bin.
    """
    tree, out, opened = CapacityTree(), [0] * len(items), bins or 0
    for b in range(opened):
        tree.insert((capacity, b))
    for k in sorted(range(len(items)), key=lambda k: (-items[k][0], items[k][1])):
        size = items[k][0]
        entry = tree.ceiling((size, -1))
        if entry is None and bins:
            entry = tree.maximum()
        if entry is None:
            entry, opened = (max(capacity, size), opened), opened + 1
        else:
            tree.delete(entry)
        out[k] = entry[1]
        tree.insert((entry[0] - size, entry[1]))
    return out


def best_fit_of_sizes(sizes: list[tuple[int, int]], capacity: int, bins: int) -> list[tuple[int, int, int, int]]:
    """(size, from, to, bin): which of the equal items of each (size, count) enter which bin, by the rule of ``best_fit_decreasing`` with ``bins``.

    An item that fits leaves its bin the tightest, so equal ones follow it until the bin holds no more: a step for each bin that they enter.
    """
    tree, out = CapacityTree(), []
    for b in range(bins):
        tree.insert((capacity, b))
    for size, count in sorted(sizes, reverse=True):
        at = 0
        while at < count:
            entry = tree.ceiling((size, -1))
            fit = entry is not None
            entry = entry if fit else tree.maximum()
            some = min(count - at, max(entry[0] // size, 1)) if fit else 1
            tree.delete(entry)
            tree.insert((entry[0] - some * size, entry[1]))
            if out and out[-1][0] == size and out[-1][3] == entry[1]:
                out[-1] = (size, out[-1][1], at + some, entry[1])
            else:
                out.append((size, at, at + some, entry[1]))
            at += some
    return out


def _ranked(rows: DataFrame, key: str, chunks: int, spread: list[str], order: list[str]) -> DataFrame:
    """``rows``, a written table, with rank: a gapless number from 0 within ``key``, in chunks (hashes of ``spread``), so that no key is sorted in one task."""
    rows = rows.withColumn("_chunk", F.pmod(F.xxhash64(*spread), F.lit(chunks)))
    counts = rows.groupBy(key, "_chunk").agg(F.count("*").alias("_n"))
    before = counts.select(key, "_chunk", (F.sum("_n").over(Window.partitionBy(key).orderBy("_chunk")) - F.col("_n")).alias("_before"))
    within = F.row_number().over(Window.partitionBy(key, "_chunk").orderBy(*order)) - 1
    return rows.withColumn("_within", within).join(before, [key, "_chunk"]).withColumn("rank", F.col("_before") + F.col("_within")).drop("_chunk", "_before", "_within")


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): its size, CRC, shard and slot, under the law ``bytes``.

    A null text counts as an empty one, of size 1. Rows that are equal in doc_id and text are told apart only by
    their slots, so any order among them is the same result. Other columns are ignored, whatever their names. An
    empty table gives no rows. A group of more than 1/``shards`` of all bytes fills a shard alone.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col("text"), F.lit(""))
    base = written(
        docs.select(
            "doc_id",
            (F.octet_length(body).cast("long") + 1).alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(body, 256)).alias("group"),
        ),
        "shard-base",
    )
    groups = written(base.groupBy("group").agg(F.sum("size").alias("group_size")), "shard-groups")
    sizes = [tuple(r) for r in groups.groupBy("group_size").count().collect()]  # distinct sizes: the square root of twice all bytes at most
    total, rows = sum(s * n for s, n in sizes), sum(n for _, n in sizes)
    placed = best_fit_of_sizes(sizes, -(-total // shards), shards)
    runs = spark.createDataFrame(placed, "group_size long, lo long, hi long, shard int")
    ranked = _ranked(groups, "group_size", max(1, -(-rows // ROWS_PER_CHUNK)), ["group"], ["group"])
    of_group = ranked.join(checked_broadcast(runs), "group_size").filter("rank >= lo AND rank < hi").select("group", "shard")
    dealt = salted_join(base, written(of_group, "group-shards"), "group", "doc_id").drop("group")
    n = base.count()
    slots = _ranked(written(dealt, "dealt"), "shard", max(1, -(-n // ROWS_PER_CHUNK)), ["doc_id", "text_crc32"], ["doc_id", "text_crc32", "size"])
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("rank").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
