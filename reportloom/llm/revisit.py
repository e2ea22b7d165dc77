"""WARC: resolution of not-modified revisits.

A revisit record (a server's 304 answer) has no body. It is resolved by an as-of join on the canonical URL: the
latest earlier full response, whose validators must agree, lends its body; permitted headers of the revisit replace
those stored. Time is cut into slices, so that one very common URL is spread over tasks: within a slice the answer
comes from a window, and what earlier slices left is carried over from one row for each URL and slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headers that a 304 answer can't change in what is stored (fixed values): framing, representation, hop by hop.
KEPT_HEADERS = (
    "connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
)
#: Records of a slice of time, on average.
SLICE_ROWS = 20_000


def canonical_url(url: Column) -> Column:
    """Scheme, user, ``www.``, default port, fragment, ``utm_`` parameters and final slashes go; host in lower case, parameters sorted. Null stays null."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    place = F.regexp_extract(bare, r"^([^?]*)", 1)
    host = F.lower(F.regexp_extract(place, r"^([^/]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"^www\.", "")
    host = F.regexp_replace(host, r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(place, r"^[^/]*(.*)$", 1), "/+$", "")
    asked = F.regexp_extract(bare, r"^[^?]*\?(.*)$", 1)
    asked = F.array_join(F.array_sort(F.filter(F.split(asked, "&"), lambda p: (p != "") & ~p.startswith("utm_"))), "&")
    return F.concat(host, path, F.when(asked != "", F.concat(F.lit("?"), asked)).otherwise(F.lit("")))


def resolve_revisits(records: DataFrame, slice_units: int | None = None) -> DataFrame:
    """One row for each revisit in ``records`` (record_id, kind, url, at long, etag, last_modified, headers map<string,string>).

    kind is ``response`` or ``revisit``; other kinds and null times are left out. Returns record_id, canonical_url,
    at, state, target_id and headers. state: ``resolved``; ``changed`` when a validator that both sides have differs,
    or no validator is on both; ``orphan`` without any earlier response. Only a response at a smaller time is earlier;
    of equal times the largest record_id is the latest. headers are merged only when resolved. A null URL is an
    orphan, and takes part in no join. Repeated revisits give a row each. Names of headers are compared in lower case; of
    names that a record has twice in different case, the last one in code point order counts. Other columns are ignored, whatever their
    names. Empty tables give none.
    """
    if slice_units is None:
        lo, hi, n = records.agg(F.min("at"), F.max("at"), F.count("*")).first()
        slice_units = max(1, (hi - lo + 1) * SLICE_ROWS // max(n, 1)) if lo is not None else 1
    r = records.filter(F.col("kind").isin("response", "revisit") & F.col("at").isNotNull()).select(
        "record_id", "kind", canonical_url(F.col("url")).alias("canonical_url"), "at", "etag", "last_modified", "headers",
        F.floor(F.col("at") / F.lit(slice_units)).alias("slice"),
    )
    nowhere = r.filter("canonical_url IS NULL AND kind = 'revisit'")
    r = r.filter("canonical_url IS NOT NULL")
    full = F.when(F.col("kind") == "response", F.struct("at", "record_id", "etag", "last_modified", "headers"))
    by_time = Window.partitionBy("canonical_url", "slice").orderBy(F.col("at"), F.col("kind").desc(), F.col("record_id")).rowsBetween(Window.unboundedPreceding, -1)
    seen = r.withColumn("near", F.last(full, ignorenulls=True).over(by_time))
    order = F.when(full.isNotNull(), F.struct("at", "record_id"))
    ends = r.groupBy("canonical_url", "slice").agg(F.max_by(full, order).alias("end"))
    carried = ends.select(
        F.col("canonical_url").alias("u"), F.col("slice").alias("s"),
        F.last("end", ignorenulls=True).over(Window.partitionBy("canonical_url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)).alias("far"),
    )
    found = (
        seen.filter("kind = 'revisit'")
        .join(carried, (F.col("canonical_url") == F.col("u")) & (F.col("slice") == F.col("s")), "left")
        .withColumn("hit", F.coalesce("near", "far"))
    )
    both = lambda c: F.col(c).isNotNull() & F.col(f"hit.{c}").isNotNull()
    differ = lambda c: both(c) & (F.col(c) != F.col(f"hit.{c}"))
    state = (
        F.when(F.col("hit").isNull(), "orphan")
        .when(differ("etag") | differ("last_modified") | ~(both("etag") | both("last_modified")), "changed")
        .otherwise("resolved")
    )
    fresh = F.filter(_named(F.col("headers")), lambda e: ~e["key"].isin(*KEPT_HEADERS))
    names = F.transform(fresh, lambda e: e["key"])
    stored = F.filter(_named(F.col("hit.headers")), lambda e: ~F.array_contains(names, e["key"]))
    resolved = found.select(
        "record_id", "canonical_url", "at", state.alias("state"), F.col("hit.record_id").alias("target_id"),
        F.when(state == "resolved", F.map_from_entries(F.concat(stored, fresh))).alias("headers"),
    )
    kinds = {f.name: f.dataType for f in resolved.schema}
    bare = nowhere.select("record_id", "canonical_url", "at", F.lit("orphan").alias("state"), F.lit(None).cast(kinds["target_id"]).alias("target_id"), F.lit(None).cast(kinds["headers"]).alias("headers"))
    return resolved.unionByName(bare)


def _named(headers: Column) -> Column:
    """Entries with lower-case names; of names that occur twice the last one in code point order; none of a null map. No map is built, as maps can't hold a name twice."""
    entries = F.array_sort(F.coalesce(F.map_entries(headers), F.array()))
    names = F.transform(entries, lambda e: F.lower(e["key"]))
    last = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(names, i + 2, 1 << 20), F.lower(e["key"])))
    return F.transform(last, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))


def records_of_pages(pages: DataFrame, lag: int = 1000) -> DataFrame:
    """A crawl log of ``pages``: each page is a full response at its page_id and is asked for again ``lag`` later, answered by a 304 with its own validator."""
    body = F.coalesce(F.col("html"), F.lit(""))
    p = pages.select("page_id", "url", F.md5(body).alias("etag"), F.octet_length(body).cast("string").alias("size"))
    later = F.col("page_id") + F.lit(lag)
    pairs = lambda *kv: F.create_map(*[F.lit(x) if isinstance(x, str) else x for x in kv])
    first = p.select(
        (F.col("page_id") * 2).alias("record_id"), F.lit("response").alias("kind"), "url", F.col("page_id").alias("at"), "etag", F.lit(None).cast("string").alias("last_modified"),
        pairs("content-type", "text/html", "content-length", F.col("size"), "etag", F.col("etag"), "date", F.col("page_id").cast("string")).alias("headers"),
    )
    again = p.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"), "url", later.alias("at"), "etag", F.lit(None).cast("string").alias("last_modified"),
        pairs("Content-Length", "0", "Date", later.cast("string"), "Cache-Control", "max-age=60", "ETag", F.col("etag")).alias("headers"),
    )
    return first.unionByName(again)


def header_text(headers: Column) -> Column:
    """Headers as sorted ``name: value`` lines."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")


ORACLE_SQL = r"""
WITH c AS (
  SELECT page_id, md5(coalesce(html, '')) AS etag, strlen(coalesce(html, '')) AS size,
         regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM pages),
k AS (
  SELECT page_id, etag, size, bare, regexp_extract(bare, '^([^?]*)', 1) AS place,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '^[^?]*\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT starts_with(p, 'utm_'))), '&') AS asked FROM c),
u AS (
  SELECT page_id, etag, size,
         regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(place, '^([^/]*)', 1)), '^.*@', ''), '^www\.', ''), ':(80|443)$', '')
         || regexp_replace(regexp_extract(place, '^[^/]*(.*)$', 1), '/+$', '') || CASE WHEN asked <> '' THEN '?' || asked ELSE '' END AS url FROM k),
j AS (
  SELECT a.page_id, a.url, a.etag, a.page_id + 1000 AS "at", b.page_id AS target, b.etag AS old, b.size AS size FROM u a
  LEFT JOIN LATERAL (SELECT * FROM u x WHERE x.url = a.url AND x.page_id < a.page_id + 1000 ORDER BY x.page_id DESC LIMIT 1) b ON true)
SELECT page_id * 2 + 1 AS record_id, url AS canonical_url, "at",
       CASE WHEN target IS NULL THEN 'orphan' WHEN etag <> old THEN 'changed' ELSE 'resolved' END AS state,
       target * 2 AS target_id,
       CASE WHEN etag = old THEN 'cache-control: max-age=60' || chr(10) || 'content-length: ' || size || chr(10) || 'content-type: text/html'
            || chr(10) || 'date: ' || "at" || chr(10) || 'etag: ' || etag END AS headers
FROM j
"""
