"""DuckDB SQL of the section split over the synthetic reports, written on its own: joins and windows where Spark has arrays."""

from __future__ import annotations

from ..operators import catalog
from .corpus import REPORTS

_HAN = "一-龥"
_BLANKS = r"[\s\x{3000}\x{a0}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_BLANKS}+|{_BLANKS}+$', '', 'g')"


def _rows() -> str:
    """The catalogue as VALUES; RE2 has no look-behind, so patterns take one more character on either side."""
    out = []
    for s, (name, aliases) in enumerate(catalog.SECTIONS.items()):
        out += [(s, name, catalog.ORDER[name], a, alias, t) for a, alias in enumerate(aliases.split(" ")) for t in (1, 2)]
    for name, aliases in catalog.FALLBACK.items():
        if name in catalog.SECTIONS:
            out += [(list(catalog.SECTIONS).index(name), name, catalog.ORDER[name], a, alias, 3) for a, alias in enumerate(aliases.split(" "))]
    lead = {1: rf"(?:{catalog.NUMBERING}[ \t]*)", 2: "", 3: rf"(?:{catalog.NUMBERING}[ \t]*)?"}
    return ", ".join(f"({s}, '{n}', {o}, {a}, '{alias}', {t}, '(^|[^{_HAN}])({lead[t]}{catalog.body(alias)})([^{_HAN}]|$)')" for s, n, o, a, alias, t in out)


_LIST = lambda names: "[" + ", ".join(f"'{n}'" for n in names) + "]"
_GATE = """gate AS (SELECT doc_id, text, contains(array_to_string(string_split(text, chr(10))[1:30], chr(10)), '年度报告摘要') AS summary,
  CASE WHEN length(text) = 0 THEN 'empty' WHEN length(text) < 500 THEN 'short' WHEN ((length(text) - length(replace(text, '(cid:', ''))) // 5) * 20 > length(text) THEN 'cid'
   WHEN length(translate(text, ' ' || chr(10), '')) = 0 OR len(regexp_extract_all(text, '[\\x{4e00}-\\x{9fff}]')) * 100 < length(translate(text, ' ' || chr(10), '')) * 15 THEN 'few_cjk' END AS why FROM reports)"""
_FOUND = rf"""
 cat(section_idx, canonical, ord, alias_idx, alias, tier, pat) AS (VALUES {_rows()}),
 ls AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM gate WHERE NOT summary AND why IS NULL),
 li AS (SELECT doc_id, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM ls),
 hit AS (SELECT doc_id, base, line, {_strip('line')} AS s, c.*, regexp_extract(line, pat, 0) AS g, length(regexp_extract(line, pat, 1)) AS skip, length(regexp_extract(line, pat, 2)) AS n
  FROM li JOIN cat c ON contains(translate(line, ' ' || chr(9), ''), alias) WHERE regexp_matches(line, pat)),
 pos AS (SELECT *, strpos(line, g) - 1 + skip AS a, strpos(line, g) - 1 + skip + n AS b FROM hit),
 part AS (SELECT *, substr(s, b + 1) AS after, {_strip('substr(s, 1, a)')} AS before, substr(s, a + 1, b - a) AS part FROM pos),
 sign AS (SELECT *, regexp_matches(before, '{catalog.PAGE_HEADER}') AS header, NOT regexp_matches(part, '{catalog.NUMBERING}') AS loose FROM part),
 good AS (SELECT *, base + a AS start, base + b AS stop FROM sign WHERE NOT (length(s) = 0 OR length(after) - length(translate(after, '.．…·', '')) > 5
  OR length(s) - length(replace(s, '/', '')) >= 2 OR length(s) - length(replace(s, '-', '')) >= 3 OR length(s) - length(replace(s, '—', '')) >= 2
  OR regexp_matches({_strip('after')}, '^[0-9]+$') OR regexp_matches(s, '{_BLANKS}{{5,}}[0-9]+$') OR regexp_matches(s, '^[0-9]+{_BLANKS}+') OR regexp_matches(before, '详见|参见|请参阅|参考|阅读|查阅|["“”]')
  OR (loose AND before <> '' AND NOT header AND NOT regexp_matches(before, '^(?:{catalog.NUMBERING}|[0-9]+\s*[、.．])?$') AND length(before) <= 20 AND regexp_matches(before, '[{_HAN}]{{3,}}'))
  OR (loose AND (b - a) / length(s) < CASE WHEN header THEN 0.1 ELSE 0.25 END))),
 capped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, section_idx, tier ORDER BY alias_idx, start) AS r FROM good)
  WHERE (tier = 1 OR r <= CASE tier WHEN 2 THEN 20 ELSE 10 END) AND (tier <> 2 OR start >= 1000 OR length(s) > 6))"""
_RANK = f"list_position({_LIST(catalog.ANCHORS)}, canonical)"
_SKIP = f"""
 anchor AS (SELECT doc_id, min(k) AS k, arg_min(start, (k, start)) AS at FROM (SELECT *, {_RANK} AS k FROM capped) WHERE tier < 3 AND k > 0 AND (start >= 1000 OR tier = 1) GROUP BY 1),
 seen AS (SELECT c.*, a.k, a.at, coalesce(tier = 3 OR start >= a.at + 200, true) AS late, coalesce(tier < 3 AND {_RANK} = a.k, false) AS own FROM capped c LEFT JOIN anchor a USING (doc_id)),
 turn AS (SELECT *, row_number() OVER (PARTITION BY doc_id, own ORDER BY tier, alias_idx, start) AS nth, bool_or(late AND own AND tier = 1) OVER (PARTITION BY doc_id) AS strong FROM seen),
 kept AS (SELECT * FROM turn WHERE late OR (own AND nth = 1 AND NOT strong))"""
_NAME = lambda x: f"{x}.canonical || '(' || {x}.ord || ')'"
_FOLD = f"""
 line_up AS (SELECT doc_id, list(struct_pack(tier := tier, start := start, section_idx := section_idx, alias_idx := alias_idx, stop := stop, canonical := canonical, ord := ord, alias := alias, s := s, why := CAST(NULL AS VARCHAR))
   ORDER BY tier, start, CASE WHEN tier < 3 THEN -length(alias) ELSE 0 END, section_idx, alias_idx) AS items FROM kept GROUP BY 1),
 tried AS (SELECT doc_id, list_reduce(list_transform(items, lambda c: [c]), lambda acc, c:
   CASE WHEN c[1].tier = 3 AND len(list_filter(acc, lambda a: a.why IS NULL AND a.canonical = c[1].canonical AND a.tier < 3)) > 0 THEN acc
   ELSE list_concat(acc, [struct_pack(tier := c[1].tier, start := c[1].start, section_idx := c[1].section_idx, alias_idx := c[1].alias_idx, stop := c[1].stop, canonical := c[1].canonical, ord := c[1].ord, alias := c[1].alias, s := c[1].s, why := CASE
    WHEN len(list_filter(acc, lambda a: a.why IS NULL AND a.canonical = c[1].canonical)) > 0
     THEN CASE c[1].tier WHEN 1 THEN 'duplicate_section_not_overwrite' WHEN 2 THEN 'weak_match_after_strong_exists' ELSE 'fallback_after_exists' END
    WHEN len(list_filter(acc, lambda a: a.why IS NULL AND a.start <= c[1].start AND a.ord > c[1].ord)) > 0
     THEN 'section_order_inversion:' || list_transform(list_reverse_sort(list_transform(list_filter(acc, lambda a: a.why IS NULL AND a.start <= c[1].start), lambda a: struct_pack(start := a.start, ord := a.ord, canonical := a.canonical))), lambda p: {_NAME('p')})[1] || ' -> ' || c[1].canonical || '(' || c[1].ord || ')'
    WHEN len(list_filter(acc, lambda a: a.why IS NULL AND a.start > c[1].start AND a.ord < c[1].ord)) > 0
     THEN 'section_order_inversion:' || c[1].canonical || '(' || c[1].ord || ') -> ' || list_transform(list_sort(list_transform(list_filter(acc, lambda a: a.why IS NULL AND a.start > c[1].start), lambda a: struct_pack(start := a.start, ord := a.ord, canonical := a.canonical))), lambda p: {_NAME('p')})[1]
    END)]) END) AS items FROM line_up),
 told AS (SELECT doc_id, unnest(items, recursive := true) FROM tried),
 near AS (SELECT *, lag(canonical) OVER w AS pc, lag(start) OVER w AS ps, lead(canonical) OVER w AS nc, lead(start) OVER w AS ns FROM told WHERE why IS NULL WINDOW w AS (PARTITION BY doc_id ORDER BY start, ord, section_idx)),
 judged AS (SELECT doc_id, tier, start, section_idx, stop, canonical, ord, alias, s, CASE WHEN canonical = '审计报告' AND ((pc = '财务报告' AND start - ps < 500) OR (nc = '财务报告' AND ns - start < 500)) THEN 'merged_into_adjacent_财务报告' END AS why FROM near
   UNION ALL SELECT doc_id, tier, start, section_idx, stop, canonical, ord, alias, s, why FROM told WHERE why IS NOT NULL),
 won AS (SELECT * FROM judged WHERE why IS NULL)"""
_SPANS = """
 closed AS (SELECT doc_id, ord, canonical, start, lead(start) OVER (PARTITION BY doc_id ORDER BY start, ord, section_idx) AS next FROM won
   UNION ALL SELECT doc_id, 10, '前言及重要提示', 0, min(start) FROM won GROUP BY doc_id HAVING min(start) > 0),
 cut AS (SELECT doc_id, ord, canonical, start, coalesce(next, length(text)) AS "end", substr(text, CAST(start + 1 AS BIGINT), CAST(coalesce(next, length(text)) - start AS BIGINT)) AS content FROM closed JOIN gate USING (doc_id)),
 spans AS (SELECT * FROM cut WHERE canonical <> '前言及重要提示' OR regexp_matches(content, '[^\\s\\x{3000}\\x{a0}]'))"""
WITH_FOUND = f"WITH reports AS ({REPORTS}), {_GATE}, {_FOUND}"
WITH_SPANS = f"{WITH_FOUND}, {_SKIP}, {_FOLD}, {_SPANS}"
CANDIDATES = f"{WITH_FOUND} SELECT doc_id, canonical, tier, count(*) AS n, CAST(min(start) AS INTEGER) AS first, CAST(max(stop) AS INTEGER) AS last FROM capped GROUP BY 1, 2, 3"
KEPT = f"{WITH_FOUND}, {_SKIP} SELECT doc_id, count(*) AS n, CAST(min(start) AS INTEGER) AS first, CAST(sum(stop) AS BIGINT) AS ends FROM kept GROUP BY 1"
REJECTED = f"{WITH_FOUND}, {_SKIP}, {_FOLD} SELECT doc_id, canonical, tier, CAST(start AS INTEGER) AS start, alias, substr(s, 1, 100) AS line_preview, why AS reason FROM judged WHERE why IS NOT NULL"
SECTIONS = f"""{WITH_SPANS} SELECT doc_id, ord, canonical, CAST(start AS INTEGER) AS start, CAST("end" AS INTEGER) AS "end", CAST(length(content) AS INTEGER) AS n_chars, md5(content) AS content_md5 FROM spans"""
LOSSLESS = f"{WITH_SPANS} SELECT doc_id, string_agg(content, '' ORDER BY start, ord) = any_value(text) AS lossless FROM spans JOIN gate USING (doc_id) GROUP BY doc_id"
_NAMES = _LIST(catalog.SECTIONS)
_DETAILS = f"""
 per AS (SELECT doc_id, string_agg(canonical || ':' || length(content), '+' ORDER BY canonical || ':' || length(content)) AS sizes, bool_or(NOT regexp_matches(content, '[^\\s\\x{{3000}}\\x{{a0}}]')) AS blank FROM spans GROUP BY 1),
 won_by AS (SELECT doc_id, list(canonical) AS have, bool_or(tier = 3) AS used, count(*) AS final FROM won GROUP BY 1),
 first_by AS (SELECT doc_id, list(canonical) AS have FROM judged WHERE tier < 3 AND (why IS NULL OR starts_with(why, 'merged')) GROUP BY 1),
 raw AS (SELECT doc_id, count(*) AS n FROM capped WHERE tier < 3 GROUP BY 1), aft AS (SELECT doc_id, count(*) AS n FROM kept WHERE tier < 3 GROUP BY 1),
 rej AS (SELECT doc_id, count(*) AS n FROM judged WHERE why IS NOT NULL GROUP BY 1),
 meta AS (SELECT doc_id, CASE WHEN summary THEN 'ignored_summary' WHEN gate.why IS NOT NULL THEN 'ignored_low_quality' WHEN final IS NULL THEN 'failed' WHEN blank THEN 'warning' ELSE 'success' END AS status,
  CASE WHEN NOT summary THEN gate.why END AS reason, CAST(length(text) AS INTEGER) AS total_chars, CAST(coalesce(raw.n, 0) AS INTEGER) AS raw_matches, CAST(coalesce(aft.n, 0) AS INTEGER) AS after_contents, CAST(coalesce(final, 0) AS INTEGER) AS final,
  coalesce(used, false) AS used_fallback,
  CASE WHEN NOT summary AND gate.why IS NULL THEN array_to_string(list_filter({_NAMES}, lambda x: NOT list_contains(coalesce(first_by.have, []), x)), '+') END AS missing_before,
  array_to_string(list_filter({_NAMES}, lambda x: NOT list_contains(coalesce(won_by.have, []), x)), '+') AS missing, sizes, CAST(coalesce(rej.n, 0) AS INTEGER) AS rejected
  FROM gate LEFT JOIN per USING (doc_id) LEFT JOIN won_by USING (doc_id) LEFT JOIN first_by USING (doc_id) LEFT JOIN raw USING (doc_id) LEFT JOIN aft USING (doc_id) LEFT JOIN rej USING (doc_id))"""
DETAILS = f"{WITH_SPANS}, {_DETAILS} SELECT * FROM meta"
STATUS = f"{WITH_SPANS}, {_DETAILS} SELECT status, CASE status WHEN 'failed' THEN 0 WHEN 'warning' THEN 1 WHEN 'success' THEN 2 WHEN 'ignored_summary' THEN 3 ELSE 4 END AS status_rank, count(*) AS docs FROM meta GROUP BY 1, 2"
