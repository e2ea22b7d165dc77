"""BPE encoding and decoding by batched numpy merge rounds.

Words of many texts lie in one flat array of symbols. In each round the keys of neighbouring pairs are looked up by
binary search among the sorted keys of all merges, each word's lowest-ranked pair is merged wherever it stands, and
words without a known pair leave the array. A worker keeps what it has encoded, so a word is worked on once.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches

#: Words that a worker keeps; beyond that it starts anew.
CACHE_WORDS = 300_000
NONE = np.iinfo(np.int64).max
SPACE = regex.compile(r"\p{White_Space}+")
#: Characters that str.split() takes for blanks and Unicode doesn't.
ODD = regex.compile("[\x1c-\x1f]")
# Where the library's Unicode tables differ from those of Python and of the regex module (code points, hexadecimal).
#: Letters and numbers that regex knows and the library's word pattern doesn't: those assigned after Unicode 16 or left out of its tables.
NO_LETTERS = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F "
    "12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF "
    "1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
#: Marks that Python reorders or composes in NFC and the library takes for plain characters, as its tables for NFC are older.
NO_MARKS = (
    "7FD 898-89F 8CA-8D3 9FE C3C D3B-D3C EBA 1715 1ABF-1ACE 1DF6-1DFA A82C 10D24-10D27 10EAB-10EAC 10EFD-10EFF 10F46-10F50 10F82-10F85 11070 1133B 1145E 11839-1183A 11930 11935 11938 1193D-1193E 11943 "
    "119E0 11A34 11A47 11A99 11D42 11D44-11D45 11D97 11F41-11F42 16FF0-16FF1 1E08F 1E130-1E136 1E2AE 1E2EC-1E2EF 1E4EC-1E4EF"
)
#: Capitals whose small letters the library knows and Python may not: ranges, and how far the small letter is.
CAPITALS = "1C89:1 A7CB:-A567 A7CC:1 A7CE:1 A7D2:1 A7D4:1 A7DA:1 A7DC:-A641 10D50-10D65:20 16EA0-16EB8:1B"


def points(ranges: str) -> str:
    """Ranges of code points as the inside of a character class."""
    return "".join("-".join(f"\\U{int(x, 16):08X}" for x in r.split("-")) for r in ranges.split())


def small_letters(ranges: str) -> dict[int, int]:
    out = {}
    for r in ranges.split():
        span, far = r.split(":")
        ends = [int(x, 16) for x in span.split("-")]
        out |= {c: c + int(far, 16) for c in range(ends[0], ends[-1] + 1)}
    return out


PLAIN_MARKS = regex.compile(f"([{points(NO_MARKS)}])")
SMALL = small_letters(CAPITALS)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it prints in Latin-1, else the next one from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in prints else next(spare)) for b in range(256)]


class WordBpe:
    """The tokenizer of a file with BPE merges and word ends, as the tokenizers library reads it."""

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in vocab.items()} | {a["id"]: a["content"] for a in spec["added_tokens"]}
        self.texts = {i: str(i) for i in self.tokens}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.split_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        for plain, own in (("[\\p{L}]+", "LETTERS+"), ("[\\p{N}]", "NUMBERS"), ("[^\\s\\p{L}\\p{N}]+", "OTHERS+")):
            if plain not in pattern:
                raise ValueError(f"a word pattern without {plain} is not supported: {pattern}")
            pattern = pattern.replace(plain, own)
        late = points(NO_LETTERS)
        classes = {"LETTERS": f"[\\p{{L}}--[{late}]]", "NUMBERS": f"[\\p{{N}}--[{late}]]", "OTHERS": f"[[^\\p{{White_Space}}\\p{{L}}\\p{{N}}]||[{late}]]"}
        for name, own in classes.items():
            pattern = pattern.replace(name, own)
        self.words = regex.compile(pattern, regex.V1)
        letters = byte_letters()
        self.first = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + self.end] for c in letters], np.int64)
        self.base = max(self.tokens) + 1
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in map(lambda m: m if isinstance(m, list) else m.split(" "), model["merges"])]
        keys = np.array([a * self.base + b for a, b, _ in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), np.array([m for *_, m in pairs], np.int64)
        self.cache: dict[str, tuple[int, str, str]] = {}

    def merge(self, words: list[str]) -> tuple[np.ndarray, list[int]]:
        """The ids of all words, one after another, and where each word's end. No word may be empty."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        flat = np.frombuffer(b"".join(raw), np.uint8)
        lens = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(lens) - 1
        sym = self.first[flat]
        sym[ends] = self.last[flat[ends]]
        word = np.repeat(np.arange(len(raw)), lens)
        done_sym, done_word = [], []
        while len(sym):
            same = word[1:] == word[:-1]
            key = np.where(same, sym[:-1] * self.base + sym[1:], -1)
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.append(np.where(self.keys[at] == key, self.rank[at], NONE), NONE)
            starts = np.flatnonzero(np.append(True, ~same))
            least = np.minimum.reduceat(rank, starts)
            size = np.diff(np.append(starts, len(sym)))
            lowest = np.repeat(least, size)
            live = lowest != NONE
            done_sym.append(sym[~live])
            done_word.append(word[~live])
            hit = live & (rank == lowest)
            where = np.flatnonzero(hit)
            if not len(where):
                break
            # of pairs that overlap (aaa), every second one from the left is merged
            breaks = np.append(True, np.diff(where) > 1)
            run = np.flatnonzero(breaks)
            where = where[(np.arange(len(where)) - np.repeat(run, np.diff(np.append(run, len(where))))) % 2 == 0]
            sym[where] = self.made[rank[where]]
            live[where + 1] = False
            sym, word = sym[live], word[live]
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return sym[order], np.cumsum(np.bincount(word, minlength=len(raw))).tolist()

    def normal(self, text: str) -> str:
        """NFC, then lower case letter by letter (a final sigma has no form of its own). Blanks only part words here."""
        if text.isascii():
            return text.lower()
        if PLAIN_MARKS.search(text):
            text = "".join([unicodedata.normalize("NFC", t) for t in PLAIN_MARKS.split(text)])
        else:
            text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").translate(SMALL).lower()

    def pieces(self, text: str) -> list[str]:
        """Words and special tokens of a text, in order. Special tokens are looked for before normalisation."""
        if not self.split_special or "<" not in text:
            return self.words.findall(self.normal(text))
        out, at = [], 0
        for m in self.split_special.finditer(text):
            out += self.words.findall(self.normal(text[at : m.start()]))
            out.append(m.group())
            at = m.end()
        return out + self.words.findall(self.normal(text[at:]))

    def learn(self, runs: set[str]) -> None:
        """Puts runs of non-blanks into the cache: number of ids, the ids and the tokens, each joined by spaces."""
        new = [r for r in runs if r not in self.cache]
        if not new:
            return
        # all at once, parted by line ends, which neither step makes, moves or takes away
        plain = self.normal("\n".join(new)).split("\n")
        parts = [[n] if n.isascii() and n.isalpha() else self.pieces(r) if "<|" in r else self.words.findall(n) for r, n in zip(new, plain)]
        words = list(set().union(*parts) - self.special.keys())
        known = {w: (1, str(i), w) for w, i in self.special.items()}
        if words:
            flat, ends = self.merge(words)
            flat = flat.tolist()
            ids, tokens = [self.texts[i] for i in flat], [self.tokens[i] for i in flat]
            for w, a, b in zip(words, [0, *ends], ends):
                known[w] = (b - a, " ".join(ids[a:b]), " ".join(tokens[a:b]))
        for r, p in zip(new, parts):
            if len(p) == 1:
                self.cache[r] = known[p[0]]
            else:
                own = [known[w] for w in p]
                self.cache[r] = (sum([k[0] for k in own]), " ".join([k[1] for k in own]), " ".join([k[2] for k in own]))

    def decode(self, ids: list[int]) -> str:
        """As the library does without a decoder: tokens joined by spaces, special ones kept."""
        return " ".join([self.tokens[i] for i in ids if i in self.tokens])

    def encode_batch(self, texts: list[str | None], chars: int = 1_000_000) -> Iterator[tuple[int, str, str]]:
        """Of each text: number of ids, ids joined by spaces, decoded text. Null counts as empty.

        Texts of about ``chars`` characters are looked up together.
        """
        held, size = [], 0
        for text in texts:
            text = text or ""
            held.append(SPACE.split(text) if ODD.search(text) else text.split())
            size += len(text)
            if size >= chars:
                yield from self._encode(held)
                held, size = [], 0
        yield from self._encode(held)

    def _encode(self, texts: list[list[str]]) -> Iterator[tuple[int, str, str]]:
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        self.learn(set().union(*texts))
        for runs in texts:
            found = [f for f in map(self.cache.__getitem__, runs) if f[0]]
            yield sum([f[0] for f in found]), " ".join([f[1] for f in found]), " ".join([f[2] for f in found])

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for i in next(self.encode_batch([text]))[1].split()]


_LOADED: dict[str, WordBpe] = {}


def tokenizer(source: str) -> WordBpe:
    """One tokenizer a worker, by the file's content."""
    key = hashlib.sha256(source.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = WordBpe(source)
    return _LOADED[key]


def default_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def encode(docs: DataFrame, path: str | None = None, full: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row; with ``full`` also ids array<int> and decoded.

    The file at ``path`` is read on the driver and broadcast (its size doesn't depend on the data). Null and empty
    texts have no tokens; repeated rows give repeated results; other columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    with open(path or default_path(), encoding="utf-8") as f:
        source = spark.sparkContext.broadcast(f.read())
    sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
    more = ", ids array<int>, decoded string" if full else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(source.value)
        for b in batches:
            rows = list(bpe.encode_batch(b.column(1).to_pylist()))
            cols = [b.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([sha(r[1]) for r in rows], pa.string()), pa.array([sha(r[2]) for r in rows], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if full:
                cols += [pa.array([list(map(int, r[1].split())) for r in rows], pa.list_(pa.int32())), pa.array([r[2] for r in rows], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
