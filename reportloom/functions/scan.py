"""Whole texts read in Python: character tests that a search per character makes too slow in the JVM.

Every function takes Arrow arrays of texts, so a row's lines are tested where the row is and nothing is shuffled.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# functions travel to the workers as they are, which needn't have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of an Arrow batch: texts can be long.
BATCH_ROWS = 256
#: What \s with (?U) is in Java.
BLANKS = "\t\n\x0b\f\r \x85\xa0                　"
#: Lines up to this length are remembered with their results, so many of them at most.
SHORT, KEPT = 200, 20_000


def small_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def remembered(f: Callable[[str], list]) -> Callable[[str], list]:
    """``f`` of a line; short lines come again in many texts."""
    known: dict[str, list] = {}

    def get(line: str) -> list:
        if len(line) > SHORT:
            return f(line)
        got = known.get(line)
        if got is None:
            if len(known) >= KEPT:
                known.clear()
            got = known[line] = f(line)
        return got

    return get


def lists(per_row: list[int | None], fields: dict[str, pa.Array]) -> pa.Array:
    """array<struct> of flat columns; per_row: how many items each row has, None for a null."""
    ends, at = [], 0
    for n in per_row:
        ends.append(None if n is None else at)
        at += n or 0
    return pa.ListArray.from_arrays(pa.array([*ends, at], pa.int32()), pa.StructArray.from_arrays(list(fields.values()), names=list(fields)))


def texts_of(texts: pa.Array):
    return (x.as_py() for x in texts)


_HAN = re.compile("[一-鿿]+")


def _verdict(t: str, least: int) -> str:
    n = len(t)
    at = t.find("年度报告摘要")
    if at >= 0 and t.count("\n", 0, at) < 30:
        return "summary"
    if n == 0:
        return "empty"
    if n < least:
        return "short"
    if t.count("(cid:") * 20 > n:
        return "cid"
    inked, han = n - t.count(" ") - t.count("\n"), 0
    for lo in range(0, n, 4096):
        han += sum(map(len, _HAN.findall(t, lo, lo + 4096)))
        if inked and han * 100 >= inked * 15:
            return ""
    return "few_cjk"


def verdict(text: Column, least: int) -> Column:
    """What speaks against a text, else an empty string: a summary in the first 30 lines, then empty, short, undecoded or hardly Chinese texts."""

    @F.arrow_udf("string")
    def judged(texts: pa.Array) -> pa.Array:
        return pa.array([_verdict(t or "", least) for t in texts_of(texts)], pa.string())

    # not deterministic, so that a condition on the result isn't pushed below, which would judge every text twice
    return judged.asNondeterministic()(text)


# what (?m) in Java takes for the beginning and the end of a line
_BEGIN = "(?:(?<=[\n\x85  ])|(?<=\r)(?!\n)|\\A)"
_END = "(?:(?=[\r\x85  ])|(?<!\r)(?=\n)|\\Z)"


def translated(java: str) -> str:
    """A pattern with Java's flags (?U), (?m) or (?mU) in Python's form; \\s isn't inside a class."""
    flags, body = re.match(r"(?:\(\?([mU]+)\))?(.*)", java, re.S).groups()
    flags = flags or ""
    body = body.replace(r"\s", f"[{BLANKS if 'U' in flags else BLANKS[:6]}]")
    begin, end = (_BEGIN, _END) if "m" in flags else (r"\A", r"(?=[\r\n\x85  ]?\Z)")
    return re.sub(r"(?<![\[\\])\^|(?<!\\)\$", lambda m: begin if m[0] == "^" else end, body)


_DOLLAR = "(?:\\Z|(?=\r\n\\Z|[\r\x85\u2028\u2029]\\Z)|(?<!\r)(?=\n\\Z))"


def compiled(java: str) -> re.Pattern:
    """A pattern with Java's flags (?U), (?iU) or none as Python's: what blanks and digits are, where ``.`` stops and ``$`` stands."""
    flags, body = re.match(r"(?:\(\?([iU]+)\))?(.*)", java, re.S).groups()
    wide = "U" in (flags or "")
    blanks, digits = (BLANKS, r"\d") if wide else (BLANKS[:6], "0-9")
    outer = {r"\s": f"[{blanks}]", r"\d": f"[{digits}]", ".": "[^\n\r\x85\u2028\u2029]", "^": r"\A", "$": _DOLLAR}
    inner = {r"\s": blanks, r"\d": digits}
    out, inside = [], False
    for token in re.findall(r"\\.|.", body, re.S):
        out.append((inner if inside else outer).get(token, token))
        inside = token == "[" or inside and token != "]"
    return re.compile("".join(out), re.I if "i" in (flags or "") else 0)


#: A pattern of lines that hold something alone: what follows is sought first, then the blanks before it up to a line's beginning.
ALONE = r"(?mU)^\s*"


def _alone(t: str, rest: re.Pattern, begin: re.Pattern) -> list[tuple[int, int]]:
    out, last, at = [], 0, 0
    while m := rest.search(t, at):
        lo = m.start()
        while lo > last and t[lo - 1] in BLANKS:
            lo -= 1
        a = next((i for i in range(lo, m.start() + 1) if begin.match(t, i)), None)
        if a is None:
            at = m.start() + 1
        else:
            out.append((a, m.end()))
            last = at = m.end()
    return out


def hits(text: Column, tests: list[tuple[str, str]]) -> Column:
    """array<struct<k,at,hit>> of all matches of (word, pattern) number k; a pattern is tried where its word is. A pattern may begin with (?:^|\\n): it is sought behind a line end, one set in front."""
    rows = []
    for word, p in tests:
        if p.startswith(ALONE):
            rows.append((word, None, translated("(?mU)" + p[len(ALONE) :])))
            continue
        t = translated(p)
        led = t.startswith(r"(?:\A|\n)")
        rows.append((word, led, "\n" + t[len(r"(?:\A|\n)") :] if led else t))

    @F.arrow_udf("array<struct<k:int,at:int,hit:string>>")
    def found(texts: pa.Array) -> pa.Array:
        compiled, begin = [(w, led, re.compile(p)) for w, led, p in rows], re.compile(_BEGIN)
        per, k_, at_, hit_ = [], [], [], []
        for t in texts_of(texts):
            n = len(k_)
            if t:
                ahead = "\n" + t
                for k, (word, led, p) in enumerate(compiled):
                    if word not in t:
                        continue
                    if led is None:
                        for a, b in _alone(t, p, begin):
                            k_.append(k)
                            at_.append(a)
                            hit_.append(t[a:b])
                        continue
                    for m in p.finditer(ahead if led else t):
                        a, b = m.span()
                        first = max(a - 1, 0) if led else a
                        k_.append(k)
                        at_.append(first)
                        hit_.append(t[first : b - 1 if led else b])
            per.append(len(k_) - n)
        return lists(per, {"k": pa.array(k_, pa.int32()), "at": pa.array(at_, pa.int32()), "hit": pa.array(hit_, pa.string())})

    return found.asNondeterministic()(text)


def first_place(text: Column, part: Column, patterns: dict[str, list[str]]) -> Column:
    """The place of the first match of the first of ``part``'s patterns that has one, else null."""

    @F.arrow_udf("int")
    def found(texts: pa.Array, parts: pa.Array) -> pa.Array:
        compiled = {k: [re.compile(p) for p in ps] for k, ps in rows.items()}
        each = ((t, compiled.get(k, [])) for t, k in zip(texts_of(texts), texts_of(parts)))
        return pa.array([next((m.start() for p in ps if (m := p.search(t or ""))), None) for t, ps in each], pa.int32())

    rows = {k: [translated(p) for p in ps] for k, ps in patterns.items()}
    return found.asNondeterministic()(text, part)


def all_places(text: Column, words: Column) -> Column:
    """array<array<int>>: for each of a row's words its places in the text, not overlapping; an empty or null word has none."""

    def of(t: str, word: str | None) -> list[int]:
        out, at = [], t.find(word) if word else -1
        while at >= 0:
            out.append(at)
            at = t.find(word, at + len(word))
        return out

    @F.arrow_udf("array<array<int>>")
    def found(texts: pa.Array, each: pa.Array) -> pa.Array:
        return pa.array([[of(t or "", w) for w in ws or []] for t, ws in zip(texts_of(texts), texts_of(each))], pa.list_(pa.list_(pa.int32())))

    return found.asNondeterministic()(text, words)
