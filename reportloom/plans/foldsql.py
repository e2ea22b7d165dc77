"""DuckDB SQL of the ordered folds: list_reduce over a dummy and the items, the state being the last item taken."""

from __future__ import annotations

from ..operators import financial, linescore
from .corpus import BLOCKS, FINANCIALS, REPORTS
from .splitsql import WITH_SPANS

_STRIP = lambda x: f"regexp_replace({x}, '^[\\s\\x{{3000}}\\x{{a0}}]+|[\\s\\x{{3000}}\\x{{a0}}]+$', '', 'g')"

ANSWERS = "SELECT doc_id, 'subsidiaries' AS category, 'n' || md5('Extract from: ' || coalesce(text, '')) AS name, CAST(0.5 AS DOUBLE) AS ratio FROM documents"

SUB_SECTIONS = f"""{WITH_SPANS}, f AS (SELECT doc_id, content FROM spans WHERE canonical = '财务报告'), sl AS (SELECT doc_id, unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) AS i FROM f),
 si AS (SELECT doc_id, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM sl),
 sh AS (SELECT doc_id, sub, min(s) AS s FROM si JOIN (VALUES ('body', '公司业务'), ('title', '财务')) a(sub, alias) ON length(line) < 50 AND contains(line, alias) GROUP BY 1, 2)
 SELECT doc_id, sub, CAST(s AS INTEGER) AS start, CAST(coalesce(lead(s) OVER (PARTITION BY doc_id ORDER BY s, sub), length(content)) AS INTEGER) AS "end" FROM sh JOIN f USING (doc_id)"""

MERGE = """WITH e AS (SELECT user_id AS doc_id, CAST(CAST(floor(epoch(ts)) AS BIGINT) % 1000000 AS INTEGER) AS pos, event_type AS canonical, CAST(event_id % 10 / 10 AS DOUBLE) AS confidence FROM events),
 l AS (SELECT doc_id, list({'pos': pos, 'canonical': canonical, 'confidence': confidence} ORDER BY pos, canonical, confidence) AS a FROM e GROUP BY 1),
 m AS (SELECT doc_id, unnest(list_reduce(list_transform(a, lambda x: [x]), lambda acc, c: CASE WHEN acc[-1].canonical <> c[1].canonical OR c[1].pos - acc[-1].pos >= 5000 THEN list_concat(acc, c)
  WHEN c[1].confidence > acc[-1].confidence THEN list_concat(acc[1:len(acc) - 1], c) ELSE acc END), recursive := true) FROM l)
 SELECT doc_id, pos, canonical, confidence FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, canonical ORDER BY confidence DESC, pos) AS r FROM m) WHERE r = 1"""

TITLES = ("公司简介和主要财务指标", "管理层讨论与分析", "公司治理", "重要事项", "股份变动及股东情况", "财务报告")
_OCC = lambda t: f"list_transform(range(1, len(string_split(text, {t}))), lambda i: CAST(list_sum(list_transform(string_split(text, {t})[1:i], lambda x: length(x))) + (i - 1) * length({t}) AS BIGINT))"
_FIT = "list_min(list_filter(c[1].occ, lambda p: p >= acc[-1].upto AND len(list_filter(c[1].nxt, lambda q: q >= p + c[1].n AND q - p < 300)) = 0))"
PLACES = f"""WITH reports AS ({REPORTS}), t AS (SELECT doc_id, [{', '.join(_OCC(f"'{x}'") for x in TITLES)}] AS o FROM reports),
 s AS (SELECT doc_id, list_concat([[{{'idx': CAST(-1 AS BIGINT), 'pos': CAST(NULL AS BIGINT), 'upto': CAST(0 AS BIGINT), 'occ': CAST([] AS BIGINT[]), 'nxt': CAST([] AS BIGINT[]), 'n': CAST(0 AS BIGINT)}}]],
  list_transform(range(0, 6), lambda i: [{{'idx': i, 'pos': CAST(NULL AS BIGINT), 'upto': CAST(0 AS BIGINT), 'occ': o[i + 1], 'nxt': coalesce(o[i + 2], []), 'n': CAST(length({list(TITLES)}[i + 1]) AS BIGINT)}}])) AS items FROM t),
 f AS (SELECT doc_id, unnest(list_reduce(items, lambda acc, c: list_concat(acc, [{{'idx': c[1].idx, 'pos': {_FIT}, 'upto': CASE WHEN {_FIT} IS NOT NULL THEN {_FIT} + c[1].n WHEN len(list_filter(c[1].occ, lambda p: p >= acc[-1].upto)) > 0 THEN list_max(c[1].occ) + c[1].n ELSE acc[-1].upto END,
  'occ': c[1].occ, 'nxt': c[1].nxt, 'n': c[1].n}}])), recursive := true) FROM s)
 SELECT doc_id, CAST(idx AS INTEGER) AS idx, {list(TITLES)}[idx + 1] AS title, CAST(pos AS INTEGER) AS pos FROM f WHERE pos IS NOT NULL"""


def picked(candidates: str) -> str:
    names = [n for n in linescore.ALIASES if not n.startswith("_")]
    return f"""WITH cand AS ({candidates}), l AS (SELECT doc_id, list({{'k': list_position({names}, canonical), 'start': start, 'canonical': canonical, 'points': points}} ORDER BY list_position({names}, canonical), start, line_no) AS a FROM cand WHERE NOT starts_with(canonical, '_') GROUP BY 1),
 m AS (SELECT doc_id, list_reduce(list_transform(a, lambda x: [x]), lambda acc, c: CASE WHEN acc[-1].k = c[1].k AND c[1].start - acc[-1].start < 500 THEN acc ELSE list_concat(acc, c) END) AS a FROM l),
 n AS (SELECT doc_id, unnest(list_reduce(list_transform(a, lambda x: [x]), lambda acc, c: CASE WHEN acc[-1].k = c[1].k OR c[1].start <= acc[-1].start THEN acc ELSE list_concat(acc, c) END), recursive := true) FROM m)
 SELECT doc_id, canonical, start, points FROM n"""


BLOCK_LINES = f"""WITH b AS ({BLOCKS}), l AS (SELECT doc_id, page, list({{'y0': y0, 'x0': x0, 'x1': x1, 'text': text, 'top': y0}} ORDER BY y0, x0, x1, text) AS a FROM b GROUP BY 1, 2),
 t AS (SELECT doc_id, page, list_reduce(list_transform(a, lambda x: [x]), lambda acc, c: list_concat(acc, [{{'y0': c[1].y0, 'x0': c[1].x0, 'x1': c[1].x1, 'text': c[1].text, 'top': CASE WHEN c[1].y0 - acc[-1].top <= 8 THEN acc[-1].top ELSE c[1].y0 END}}])) AS a FROM l),
 u AS (SELECT doc_id, page, unnest(a, recursive := true), generate_subscripts(a, 1) AS i FROM t),
 n AS (SELECT *, CASE WHEN top <> lag(top) OVER w OR x0 - lag(x1) OVER w > 200 THEN 1 ELSE 0 END AS new FROM u WINDOW w AS (PARTITION BY doc_id, page ORDER BY top, x0, i)),
 g AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, page ORDER BY top, x0, i) AS line_no FROM n)
 SELECT doc_id, page, CAST(line_no AS INTEGER) AS line_no, min(x0) AS x0, string_agg(text, ' ' ORDER BY x0, i) AS text FROM g GROUP BY 1, 2, 3"""

_MARGIN = "(?i)^第.*页$|^Page[\\s]*[0-9]+$|^©|^版权所有|^CONTENTS$|^目[\\s]*录$|^备查文件|^载有公司|^载有会计|^报告期内"
COLUMNS = f"""WITH b AS ({BLOCKS}), t AS (SELECT doc_id, page, x0, y0, (y0 + y1) / 2 AS mid, {_STRIP('text')} AS t, regexp_matches({_STRIP('text')}, '^[0-9]+$') AND size > 20 AS number FROM b),
 u AS (SELECT * FROM t WHERE number OR (length(t) > 1 AND NOT regexp_matches(t, '^[0-9]+$') AND NOT regexp_matches(t, '{_MARGIN}'))),
 g AS (SELECT doc_id, page, coalesce(list({{'mid': mid, 't': t, 'k': CAST(-1 AS BIGINT)}} ORDER BY y0, x0, mid, t) FILTER (number), []) AS ns, coalesce(list({{'x0': x0, 'mid': mid, 't': t}} ORDER BY y0, x0, mid, t) FILTER (NOT number), []) AS ts FROM u GROUP BY 1, 2),
 f AS (SELECT doc_id, page, ts, unnest(list_reduce(list_concat([[{{'mid': CAST(0 AS DOUBLE), 't': '', 'k': CAST(-1 AS BIGINT)}}]], list_transform(ns, lambda x: [x])), lambda acc, c: list_concat(acc, [{{'mid': c[1].mid, 't': c[1].t, 'k':
  coalesce(list_sort(list_filter(list_transform(range(0, len(ts)), lambda i: {{'d': abs(ts[i + 1].mid - c[1].mid), 'k': i}}), lambda x: x.d < 15 AND NOT list_contains(list_transform(acc, lambda a: a.k), x.k)))[1].k, -1)}}])), recursive := true) FROM g WHERE len(ns) > 0),
 r AS (SELECT doc_id, page, ts[k + 1].t AS title, ts[k + 1].x0 AS x0, CAST(t AS BIGINT) AS target FROM f WHERE k >= 0)
 SELECT doc_id, page, title, target, CASE WHEN regexp_matches(title, '^第[一二三四五六七八九十]+[章节]') THEN 0 WHEN regexp_matches(title, '^[0-9]+[.][0-9]+|^[一二三四五六七八九十]+、') THEN 1 WHEN regexp_matches(title, '^（[一二三四五六七八九十]+）') THEN 2 WHEN x0 > 595 * 0.2 THEN 1 ELSE 0 END AS level FROM r"""

_STEPS = ", ".join(f"[{{'s': '{s}', 'pos': CAST(0 AS BIGINT), 'upto': CAST(1 AS BIGINT)}}]" for s in ("", *financial.STATEMENTS))
_AT = "strpos(substr(text, acc[-1].upto), c[1].s)"
_RISKY = "|".join(financial.RISKY)
DEEP = f"""WITH fin AS ({FINANCIALS}), st AS (SELECT doc_id, unnest(list_reduce([{_STEPS}], lambda acc, c: list_concat(acc, [{{'s': c[1].s, 'pos': CASE WHEN {_AT} > 0 THEN acc[-1].upto + {_AT} - 1 ELSE 0 END, 'upto': CASE WHEN {_AT} > 0 THEN acc[-1].upto + {_AT} - 1 + length(c[1].s) ELSE acc[-1].upto END}}])), recursive := true) FROM fin),
 own AS (SELECT doc_id, pos - 1 AS pos, 0 AS rank, s AS title FROM st WHERE pos > 0),
 tl AS (SELECT doc_id, pos, substr(text, CAST(pos + 1 AS BIGINT)) AS tail FROM own JOIN fin USING (doc_id) WHERE title = '财务报表附注'),
 nl AS (SELECT doc_id, pos, unnest(string_split(tail, chr(10))) AS line, generate_subscripts(string_split(tail, chr(10)), 1) AS i FROM tl),
 ni AS (SELECT doc_id, i, line, pos + coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM nl),
 pts AS (SELECT * FROM own UNION ALL SELECT doc_id, pos, 1, {_STRIP('line')} FROM ni WHERE i > 1 AND regexp_matches(line, '^[一二三四五六七八九十]+、\\s*[^。\\n]{{2,30}}$') UNION ALL SELECT doc_id, 0, -1, '财务报告_前言' FROM fin),
 cl AS (SELECT doc_id, pos, rank, title, coalesce(lead(pos) OVER (PARTITION BY doc_id ORDER BY pos, rank, title), length(text)) AS stop FROM pts JOIN fin USING (doc_id))
 SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS sub_idx, title, CAST(pos AS INTEGER) AS start, CAST(stop AS INTEGER) AS "end",
  CASE WHEN rank < 0 THEN 'MEDIUM' WHEN rank = 1 AND regexp_matches(regexp_replace(title, '^[一二三四五六七八九十]+、\\s*', ''), '{_RISKY}') THEN 'HIGH_RISK_NOTES' ELSE 'HIGH_FINANCIALS' END AS tier FROM cl WHERE stop > pos"""

_WORDS = ", ".join(f"('{n}', '{a}')" for n, words in financial.STATEMENT_ALIASES.items() for a in words.split(" "))
STATEMENTS = f"""WITH fin AS ({FINANCIALS}), fl AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM fin),
 fi AS (SELECT doc_id, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM fl),
 h AS (SELECT doc_id, sub, min(s) AS s FROM fi JOIN (VALUES {_WORDS}) a(sub, alias) ON length(line) < 50 AND contains(line, alias) GROUP BY 1, 2),
 k AS (SELECT doc_id, sub, s, coalesce(lead(s) OVER (PARTITION BY doc_id ORDER BY s, sub), length(text)) AS e, count(*) OVER (PARTITION BY doc_id) AS n FROM h JOIN fin USING (doc_id) WHERE sub = '审计报告' OR regexp_matches(substr(text, CAST(s + 1 AS BIGINT), 300), '{'|'.join(financial.TABLE_SIGNS)}')),
 p AS (SELECT doc_id, length(text) AS total, {_OCC("'编制单位'")} AS o FROM fin), q AS (SELECT * FROM p WHERE len(o) >= 4 AND doc_id NOT IN (SELECT doc_id FROM k WHERE n > 1)),
 r AS (SELECT doc_id, total, unnest([{', '.join(f"{{'sub': '{s}', 's': {'CAST(0 AS BIGINT)' if not j else f'o[{2 * j - 1}]'}, 'e': {f'o[{2 * j + 1}]' if j < 5 else 'CAST(NULL AS BIGINT)'}}}" for j, s in enumerate(financial.STATEMENTS))}], recursive := true) FROM q)
 SELECT doc_id, sub, CAST(s AS INTEGER) AS start, CAST(e AS INTEGER) AS "end" FROM k WHERE n > 1 OR doc_id NOT IN (SELECT doc_id FROM q) UNION ALL SELECT doc_id, sub, CAST(s AS INTEGER), CAST(coalesce(e, total) AS INTEGER) FROM r WHERE s IS NOT NULL"""
