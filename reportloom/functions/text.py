"""Column functions on text, with Python's meaning of blanks and code-point offsets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Unicode blanks off both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is worked out once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def count_of(c: Column, part: str) -> Column:
    """How often a plain string occurs, not overlapping."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(part), F.lit("")))) / F.lit(len(part))).cast("int")


def newlines(c: Column) -> Column:
    """Line ends as text mode reads them, the byte-order mark gone."""
    return F.regexp_replace(F.regexp_replace(c, "^﻿", ""), "\r\n?", "\n")


def first_lines(c: Column, n: int) -> Column:
    return F.substring_index(c, "\n", n)


def safe_name(c: Column) -> Column:
    """A section's name as part of a file's name."""
    return F.translate(c, "、/", "__")


def safe_title(c: Column) -> Column:
    return F.substring(F.regexp_replace(c, r'[\\/:*?"<>|]', "_"), 1, 30)


def safe_entry(c: Column) -> Column:
    """A contents entry's title as a file's name: letters, digits and underscores, none at the ends."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)[^\w一-鿿]+", "_"), "^_+|_+$", "")


def json_array(text: Column) -> Column:
    """The JSON array in an answer: fenced code first, else from the first bracket to the last; null without one."""
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(\[.*?\])\s*```", 1)
    bare = F.regexp_extract(text, r"(?s)(\[.*\])", 1)
    return F.when(fenced != "", fenced).when(bare != "", bare)


def doc_id_parts(doc_id: Column) -> Column:
    """(code, name, year) of code_name_year: the middle parts joined; without year for two parts, without name for one."""
    p = F.split(doc_id, "_")
    n = F.size(p)
    return F.struct(
        p[0].alias("code"),
        F.when(n >= 3, F.array_join(F.slice(p, F.lit(2), F.greatest(n - 2, F.lit(0))), "_")).when(n == 2, F.get(p, F.lit(1))).otherwise("").alias("name"),
        F.when(n >= 3, F.element_at(p, -1)).otherwise("").alias("year"),
    )


def json_object(text: Column) -> Column:
    """The JSON object in an answer: fenced code first, else from the first brace to the last; null without one."""
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    bare = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    return F.when(fenced != "", fenced).when(bare != "", bare)


def html_text(html: Column) -> Column:
    """Body text of a page: scripts, styles and comments out, tags to blanks."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>|<!--.*?-->", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, "<[^>]+>", " "), r"\s+", " "))
