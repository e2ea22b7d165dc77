"""DuckDB SQL of the contents pages over the synthetic pages."""

from __future__ import annotations

from ..operators import contents
from .corpus import OUTLINES, PAGES, PRINTED, SPANS

_B = r"[\s\x{3000}\x{a0}]"
LINES = "lines AS (SELECT l_orderkey AS k, l_linenumber AS idx, min(l_suppkey) AS s FROM lineitem GROUP BY 1, 2)"


def _re(pattern: str) -> str:
    """A Java pattern with Unicode blanks and digits as RE2 reads it; blanks inside a class are spelled out too."""
    return pattern.replace("(?U)", "").replace("(?mU)", "(?m)").replace(r"\d", "[0-9]").replace(r"_\s]", r"_\s\x{3000}\x{a0}]").replace(r"\S", "§").replace(r"\s", _B).replace("§", r"[^\s\x{3000}\x{a0}]").replace("_" + _B + r"\x{3000}\x{a0}]", r"_\s\x{3000}\x{a0}]")


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_B}+|{_B}+$', '', 'g')"


def _any(words: str) -> str:
    return "|".join(words.split())


_P1, _P2 = _re(contents.ENTRY), _re(contents.ENTRY_LOOSE)
_NOT = f"(regexp_matches(title, '{_any(contents.NOT_ENTRIES)}') OR (contains(title, '原则') AND length(title) > 15) OR (starts_with(title, '{contents.NOT_WITHOUT_NUMBER}') AND NOT numbered))"
ENTRIES = f"""pages AS ({PAGES}),
 pl AS (SELECT doc_id, page_no, text, i, {_strip('raw')} AS line FROM (SELECT doc_id, page_no, text, unnest(string_split({_strip('text')}, chr(10))) AS raw, generate_subscripts(string_split({_strip('text')}, chr(10)), 1) AS i FROM pages)),
 pg AS (SELECT *, CASE WHEN regexp_matches(line, '{_P1}') THEN regexp_extract(line, '{_P1}', ['a', 'b', 'c']) ELSE regexp_extract(line, '{_P2}', ['a', 'b', 'c']) END AS g FROM pl),
 pt AS (SELECT *, g.a AS section_num, g.a <> '' AS numbered, {_strip(f"regexp_replace(g.b, '{contents.CONTINUED}', '', 'g')")} AS title, g.c AS target FROM pg),
 entries AS (SELECT doc_id, page_no, i, nullif(section_num, '') AS section_num, title, CAST(target AS INTEGER) AS page FROM pt WHERE regexp_matches(target, '^0*[0-9]{{1,3}}$') AND CAST(target AS INTEGER) BETWEEN 1 AND 500
  AND NOT (contains(line, '年度报告') AND regexp_matches(line, '目录|释义')) AND length(title) BETWEEN 4 AND 50 AND (numbered OR regexp_matches(title, '{_any(contents.CHAPTER_WORDS)}')) AND NOT {_NOT}
  AND NOT (regexp_matches(title, '[0-9]{{4,}}') AND NOT numbered) AND len(regexp_extract_all(title, '[0-9]')) < 4 AND NOT regexp_matches(title, '\\.[0-9]{{2,}}')),
 tocs AS (SELECT p.doc_id, p.page_no, p.valid, p.lines, (named AND valid >= 3) OR (valid >= 5 AND valid * 10 >= lines * 3) AS is_toc FROM (SELECT g.doc_id, g.page_no, len(string_split({_strip('g.text')}, chr(10))) AS lines, regexp_matches(g.text, '{'|'.join(contents.PAGE_WORDS)}') AS named,
  (SELECT count(*) FROM entries e WHERE e.doc_id = g.doc_id AND e.page_no = g.page_no) AS valid FROM pages g WHERE text <> '') p)"""
TOC_PAGES = f"WITH {LINES}, {ENTRIES} SELECT doc_id, page_no, CAST(valid AS INTEGER) AS valid, CAST(lines AS INTEGER) AS lines, is_toc FROM tocs"
SCANNED = f"WITH {LINES}, {ENTRIES} SELECT doc_id, page_no * 100000 + i - 1 AS idx, section_num, title, page FROM entries JOIN tocs USING (doc_id, page_no) WHERE is_toc"
_TOP = "array_to_string(string_split(text, chr(10))[1:5], chr(10))"
_H = r"(?m)^[ \t\x{3000}\n]*(第[一二三四五六七八九十]+节|[一二三四五六七八九十]+、)(.+?)$"
HEADINGS = f"""hs AS (SELECT doc_id, CAST(page_no AS BIGINT) AS idx, regexp_extract({_TOP}, '{_H}', 1) AS section_num, {_strip(f"regexp_extract({_TOP}, '{_H}', 2)")} AS title, page_no AS page FROM pages WHERE regexp_matches({_TOP}, '{_H}'))"""
CASCADE = f"""WITH {LINES}, {ENTRIES}, {HEADINGS}, ol AS ({OUTLINES}),
 u AS (SELECT doc_id, 0 AS way, 'outline' AS method, 3 AS least, CAST(idx AS BIGINT) AS idx, CAST(NULL AS VARCHAR) AS section_num, title, page FROM ol UNION ALL SELECT doc_id, 1, 'text_scan', 3, page_no * 100000 + i - 1, section_num, title, page FROM entries JOIN tocs USING (doc_id, page_no) WHERE is_toc
  UNION ALL SELECT doc_id, 2, 'fallback', 1, idx, section_num, title, page FROM hs),
 n AS (SELECT *, count(*) OVER (PARTITION BY doc_id, way) AS n FROM u), w AS (SELECT *, min(way) OVER (PARTITION BY doc_id) AS first FROM n WHERE n >= least)
 SELECT doc_id, method, idx, section_num, title, page FROM w WHERE way = first"""
_N = lambda p: f"len(regexp_extract_all(t, '{p}'))"
_M = " + ".join(_N(_re(m)) for m in contents.MARKS)
SCORES = f"""WITH sp AS ({SPANS}), g AS (SELECT doc_id, page, string_agg(text, ' ' ORDER BY y0, x0, text) AS t, count(*) FILTER (regexp_matches(text, '^[0-9]+$') AND x0 > 0.7 * 595) AS r, count(DISTINCT round(x0, 1)) FILTER (length(text) > 2) AS xs
 FROM sp WHERE length(text) >= 2 AND page < 50 GROUP BY 1, 2), p AS (SELECT doc_id, page, CASE WHEN regexp_matches(t, '(?i)目{_B}*录|contents') THEN 3 ELSE 0 END + CASE WHEN {_N(r'[.]{3,}|···|…{2,}')} >= 3 THEN 2 ELSE 0 END + CASE WHEN r >= 3 THEN 2 ELSE 0 END + CASE WHEN xs >= 3 THEN 1 ELSE 0 END
 + CASE WHEN {_M} >= 5 THEN 2 ELSE 0 END + CASE WHEN {_N('第[一二三四五六七八九十]+[章节].{2,20}?[.]{3,}')} >= 3 THEN 3 ELSE 0 END + CASE WHEN page BETWEEN 1 AND 10 THEN 1 ELSE 0 END AS points FROM g)
 SELECT doc_id, page, CAST(points AS BIGINT) AS points FROM p WHERE points >= 5"""
BEST = f"SELECT doc_id, page, points FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY points DESC, page) AS r FROM ({SCORES})) WHERE r = 1"
READABLE = f"""WITH sp AS ({SPANS}) SELECT doc_id, page, row_number() OVER (PARTITION BY doc_id, page ORDER BY y0, x0, text, x1, flags) AS order_no, text, flags // 16 % 2 = 1 AS is_bold, (x0 + x1) / 2 AS center_x, x1 - x0 AS width FROM sp WHERE length(text) >= 2"""
_FOOT = contents.FOOTERS.replace("(?iU)", "(?i)").replace(r"\s", _B).replace(r"\d", "[0-9]")
_PR = f"pr AS ({PRINTED}), pt AS (SELECT *, {_strip('text')} AS t FROM pr WHERE NOT regexp_matches(text, '{_FOOT}') AND NOT regexp_matches({_strip('text')}, '^[.·…\\s]+$'))"
_STD = r"^(.+?)(?:[.]{2,}|···|…+)?[\s\x{3000}]*([0-9]+)$"
_LESS = r"^(第[一二三四五六七八九十]+[章节]|[0-9]+[.][0-9]+)[\s\x{3000}]+(.+?)(?:[.]{2,}|···|…+)?$"
FORMATS = f"""WITH {LINES}, {_PR}, s0 AS (SELECT doc_id, page, line_no, {_strip(f"regexp_replace(regexp_replace({_strip(f"regexp_extract(t, '{_STD}', 1)")}, '[.]{{2,}}$', ''), '[·…]+$', '')")} AS title, CAST(regexp_extract(t, '{_STD}', 2) AS BIGINT) AS target FROM pt WHERE regexp_matches(t, '{_STD}') AND NOT regexp_matches(t, '^[0-9]+$')),
 s AS (SELECT * FROM s0 WHERE length(title) >= 2 AND NOT regexp_matches(title, '^[0-9]+$')),
 n0 AS (SELECT doc_id, page, line_no, CASE WHEN regexp_matches(t, '{_LESS}') THEN regexp_extract(t, '{_LESS}', 1) || ' ' || {_strip(f"regexp_extract(t, '{_LESS}', 2)")} WHEN length(text) > 2 AND length(text) < 50 AND regexp_matches(text, '{'|'.join(contents.STANDALONE)}') THEN t END AS title, CAST(-1 AS BIGINT) AS target FROM pt),
 u AS (SELECT *, 0 AS way, 'standard' AS method, 3 AS least FROM s UNION ALL SELECT *, 1, 'pageless', 3 FROM n0 WHERE title IS NOT NULL UNION ALL SELECT doc_id, page, line_no, text, CAST(line_no AS BIGINT), 2, 'columns', 1 FROM pr),
 c AS (SELECT *, count(*) OVER (PARTITION BY doc_id, way) AS n FROM u), w AS (SELECT *, min(way) OVER (PARTITION BY doc_id) AS first FROM c WHERE n >= least) SELECT doc_id, method, page, line_no, title, target FROM w WHERE way = first"""
_Q1, _Q2 = r"^(.*?[^\s\x{3000}])[\s\x{3000}]+([0-9]{1,3})$", r"^(.*?[^\s\x{3000}])[\s\x{3000}]*[.·\-…]+[\s\x{3000}]*([0-9]{1,3})$"
PLAIN = f"""WITH {LINES}, pages AS ({PAGES}), pl AS (SELECT doc_id, page_no, i, {_strip('raw')} AS line FROM (SELECT doc_id, page_no, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM pages)),
 g AS (SELECT *, CASE WHEN regexp_matches(line, '{_Q1}') THEN regexp_extract(line, '{_Q1}', ['a', 'b']) ELSE regexp_extract(line, '{_Q2}', ['a', 'b']) END AS g FROM pl),
 t AS (SELECT *, {_strip('g.a')} AS title, try_cast(g.b AS INTEGER) AS page, regexp_matches({_strip('g.a')}, '第[一二三四五六七八九十]+节') AS numbered FROM g)
 SELECT doc_id, page_no, CAST(i - 1 AS INTEGER) AS line_no, title, page FROM t WHERE length(title) BETWEEN 4 AND 50 AND page BETWEEN 1 AND 500 AND NOT {_NOT} AND (numbered OR regexp_matches(title, '{_any(contents.PLAIN_WORDS)}')) AND len(regexp_extract_all(title, '[0-9]')) * 10 <= length(title) * 3 AND NOT regexp_matches(title, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')"""
