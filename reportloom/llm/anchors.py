"""Anchored windows: what the two substring operators share.

A window is a fixed number of consecutive units (bytes, or words as hashes) of one text. In each window the gram with
the least hash (the leftmost of equals) is the window's anchor. That depends on the window's content alone, so equal
windows have the same anchor gram at the same place. Neighbouring windows mostly share their anchor; such a run of
windows is a chunk, and texts are sent as chunks, some 1 for 85 bytes or for 4.5 words, not as windows.

A count-min sketch of anchor grams, merged from the partitions' own, never underestimates how often a window occurs;
chunks whose anchor gram is estimated to occur once hold no repeated window and go no further.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import small_batches

U = np.uint64
BASE = 0x9E3779B97F4A7C15
#: Bits of a position in a packed (hash, position) value; the rest is hash.
POS = 30
#: Sketch rows, cells of a row, and the slabs in which cells are merged. What is broadcast has one bit a cell, 16 MB,
#: and doesn't grow with the data; from some 100 million anchors on it lets ever more through, but loses none.
DEPTH, WIDTH, SLABS = 2, 1 << 26, 64
#: Units that are worked on together. Longer texts come in pieces that overlap by a window.
PIECE = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def grams(units: np.ndarray, n: int) -> np.ndarray:
    """The polynomial hash of every n consecutive units, one for each place where n units stand; by doubling."""
    if len(units) < n:
        return units[:0]
    out, have, power, size = None, 0, units, 1
    while True:
        times = U(pow(BASE, size, 1 << 64))
        if n & size:
            m = len(units) - have - size + 1
            out = power if out is None else out[:m] * times + power[have : have + m]
            have += size
        if size * 2 > n:
            return out[: len(units) - n + 1]
        power = power[:-size] * times + power[size:]
        size *= 2


def least(v: np.ndarray, n: int) -> np.ndarray:
    """The minimum of every n consecutive values, by doubling."""
    if len(v) < n:
        return v[:0]
    size = 1
    while size * 2 <= n:
        v, size = np.minimum(v[:-size], v[size:]), size * 2
    return np.minimum(v[: len(v) - (n - size)], v[n - size :]) if n > size else v


@dataclass
class Chunks:
    """Chunks of some texts: text's row, first window's place in the text and in units, number of windows, anchor's distance from the first window, and the anchor gram's hash."""

    units: np.ndarray
    row: np.ndarray
    start: np.ndarray
    at: np.ndarray
    n: np.ndarray
    off: np.ndarray
    key: np.ndarray

    def take(self, keep: np.ndarray) -> Chunks:
        return Chunks(self.units, self.row[keep], self.start[keep], self.at[keep], self.n[keep], self.off[keep], self.key[keep])


def chunks(texts: Iterator[tuple[int, np.ndarray]], span: int, gram: int) -> Iterator[Chunks]:
    """Chunks of (row, units) texts, about PIECE units at a time."""
    held, size = [], 0
    for row, units in texts:
        for base in range(0, max(1, len(units) - span + 1), PIECE):
            piece = units[base : base + PIECE + span - 1]
            if len(piece) >= span:
                held.append((row, base, piece))
                size += len(piece)
            if size >= PIECE:
                yield _chunks(held, span, gram)
                held, size = [], 0
    if held:
        yield _chunks(held, span, gram)


def _chunks(held: list[tuple[int, int, np.ndarray]], span: int, gram: int) -> Chunks:
    units = np.concatenate([p for *_, p in held])
    hashes = mix(grams(units.astype(U, copy=False), gram))
    packed = (hashes >> U(POS) << U(POS)) | np.arange(len(hashes), dtype=U)
    best = least(packed, span - gram + 1)
    lens = np.array([len(p) for *_, p in held])
    begins = np.cumsum(lens) - lens
    whole = np.ones(len(units), bool)
    for b, n in zip(begins + lens - span + 1, lens):
        whole[b : b + span - 1] = False
    s = np.flatnonzero(whole)
    anchor = (best[s] & U((1 << POS) - 1)).astype(np.int64)
    first = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (s[1:] != s[:-1] + 1)))
    at, anchor = s[first], anchor[first]
    piece = np.searchsorted(begins, at, "right") - 1
    rows, bases = np.array([r for r, *_ in held]), np.array([b for _, b, _ in held])
    return Chunks(units, rows[piece], at - begins[piece] + bases[piece], at, np.diff(np.append(first, len(s))), anchor - at, hashes[anchor])


def cells(key: np.ndarray) -> list[np.ndarray]:
    """The cell of each key in each row of the sketch, rows numbered on."""
    return [(key & U(WIDTH - 1)).astype(np.int64), (mix(key + U(BASE)) & U(WIDTH - 1)).astype(np.int64) + WIDTH][:DEPTH]


def packed_counts(cell: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """A partition's own sketch: by slab, the cells counted once and those counted more often, as compressed differences."""
    cell, count = np.unique(cell, return_counts=True)
    per = DEPTH * WIDTH // SLABS
    bounds = np.searchsorted(cell, np.arange(SLABS + 1) * per)
    for slab in range(SLABS):
        a, b = bounds[slab], bounds[slab + 1]
        if a < b:
            own, many = cell[a:b] - slab * per, count[a:b] > 1
            yield slab, zlib.compress(np.diff(own * 2 + many, prepend=0).astype(np.uint32).tobytes(), 1)


def _bits(docs: DataFrame, keys: Callable[[pa.RecordBatch], Iterator[np.ndarray]], needed: int) -> np.ndarray:
    """One bit for each cell: whether it was counted ``needed`` (1 or 2) times over all partitions.

    Partition sketches meet by slab; a task holds one slab's cells. The driver gets DEPTH * WIDTH bits in all.
    """
    small_batches(docs.sparkSession)
    per = DEPTH * WIDTH // SLABS

    def own_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list[np.ndarray]) -> pa.RecordBatch:
            rows = list(packed_counts(np.concatenate(held)))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["slab", "counts"])

        held, n = [], 0
        for b in batches:
            for key in keys(b):
                held += cells(key)
                n += len(key)
                if n > 500_000:
                    yield out(held)
                    held, n = [], 0
        if n:
            yield out(held)

    def merged_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for slab, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                cell = np.cumsum(np.frombuffer(zlib.decompress(counts), np.uint32).astype(np.int64))
                own = sums.setdefault(slab, np.zeros(per, np.uint8))
                own[cell >> 1] = np.minimum(own[cell >> 1] + 1 + (cell & 1).astype(np.uint8), 2)
        for slab, own in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([slab], pa.int32()), pa.array([np.packbits(own >= needed).tobytes()], pa.binary())], names=["slab", "bits"])

    merged = docs.mapInArrow(own_counts, "slab int, counts binary").repartition(SLABS, "slab").mapInArrow(merged_counts, "slab int, bits binary").toArrow()
    bits = np.zeros((SLABS, per // 8), np.uint8)
    for slab, own in zip(merged.column(0).to_pylist(), merged.column(1).to_pylist()):
        bits[slab] = np.frombuffer(own, np.uint8)
    return bits.ravel()


def sketch(docs: DataFrame, keys: Callable[[pa.RecordBatch], Iterator[np.ndarray]]) -> np.ndarray:
    """The cells that anchor grams of ``docs`` meet twice or more; ``keys`` gives the anchor grams of a batch."""
    return _bits(docs, keys, 2)


def bits_of(keys: DataFrame) -> np.ndarray:
    """The cells of given keys (a column of longs): a filter of fixed size that passes all of them, and some others."""
    return _bits(keys, lambda b: iter([b.column(0).to_numpy(zero_copy_only=False).view(U)]), 1)


def passes(key: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which keys have all their cells set."""
    ok = np.ones(len(key), bool)
    for c in cells(key):
        ok &= (bits[c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1 == 1
    return ok
