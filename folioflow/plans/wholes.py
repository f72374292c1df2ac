"""SQL of the queries on whole documents and OCR responses."""

from __future__ import annotations

import re

from folioflow.plans import documents as d
from folioflow.plans.checks import _WS, _balanced, _segments

QUERIES: dict = {}

_NL = d._NL
_TABLE = r"(?is)<table\b.*?</table>"
_JUNK = r"regexp_matches(trim(x), '^\$?\s*!\[\]\(page=\d+(?:,bbox=\[[^\]]*\])?\)\s*\$?$') OR regexp_matches(x, '(?i)Cambridge University Press|\[Turn over\]|Licensed for hosting|Trace ID')"
_LINES = "CASE WHEN {0} LIKE '%' || chr(10) OR {0} = '' THEN string_split({0}, chr(10))[:-2] ELSE string_split({0}, chr(10)) END"
_CLEAN = f"coalesce(array_to_string(list_filter({_LINES.format('raw')}, lambda x: NOT ({_JUNK})), chr(10)), '')"


def _numbered(c: str) -> str:
    return f"len(list_filter(string_split({c}, {_NL}), lambda x: regexp_matches(x, '{d._OPEN}', 'i'))) > 0"


def _without(sql: str, first: str) -> str:
    return sql.replace(first + ",", "", 1).lstrip()


def _again(sql: str, suffix: str) -> str:
    """The steps from pages to parts under other names."""
    return re.sub(r"\b(pg|ln|op|bl|blocks|pl|po|pn|pt|parts_)\b", lambda x: x[0] + suffix, _without(sql, d._PG)).replace(f"AS {'op'}{suffix}ens", "AS opens")


def _pages(text: str) -> str:
    """pg: pages with their text; schemes; prose without them; and the number carried into each page."""
    return rf"""pg0 AS (SELECT page_id, any_value(doc_id) AS doc_id, any_value(page) AS page, any_value(width) AS width, any_value(height) AS height, coalesce(any_value(markdown), '') AS raw, any_value(elements) AS elements FROM ocr_pages GROUP BY page_id),
pg AS (SELECT page_id, doc_id, page, width, height, elements, regexp_replace({text}, '^[{_WS}]+', '') AS markdown FROM pg0),
{_without(d._SCHEME, d._PG)},
sn AS (SELECT doc_id, page, list(table_no) AS nos FROM hd WHERE len(list_filter(header, lambda x: contains(x, 'question'))) > 0 AND len(list_filter(header, lambda x: contains(x, 'answer'))) > 0 GROUP BY doc_id, page),
pc AS (SELECT p.*, regexp_extract_all(markdown, '{_TABLE}') AS ts, string_split_regex(markdown, '{_TABLE}') AS ps, coalesce(nos, []) AS nos, regexp_matches(markdown, '(?i)CANDIDATE NAME|BLANK PAGE') AS front FROM pg p LEFT JOIN sn USING (doc_id, page)),
pgu AS (SELECT page_id, doc_id, page, front, markdown AS whole, array_to_string(list_transform(ps, lambda x, i: x || CASE WHEN i > len(ts) THEN '' WHEN list_contains(nos, i - 1) THEN {_NL} ELSE ts[i] END), '') AS markdown FROM pc),
{_again(d._PARTS, "u")},
pu AS (SELECT page_id, arg_max(nullif(regexp_extract(id, '^\d{{1,2}}'), ''), ord) FILTER (WHERE regexp_matches(id, '^\d{{1,2}}')) AS number FROM parts_u GROUP BY page_id),
tu AS (SELECT doc_id, page, arg_max(regexp_extract(id, '^\d{{1,2}}'), table_no * 100000 + row_no) AS number FROM ng WHERE regexp_matches(id, '^\d{{1,2}}') GROUP BY doc_id, page),
st AS (SELECT p.*, {_numbered('whole')} AS opens, {_numbered('whole')} OR {_numbered('p.markdown')} OR NOT regexp_matches(p.markdown, '[^{_WS}]') AS own, pu.number AS pn_, tu.number AS tn_ FROM pgu p LEFT JOIN pu USING (page_id) LEFT JOIN tu ON tu.doc_id = p.doc_id AND tu.page = p.page),
sb AS (SELECT *, CASE WHEN NOT front AND own THEN coalesce(pn_, tn_) END AS a, CASE WHEN NOT front AND NOT own THEN tn_ END AS b FROM st),
ca AS (SELECT *, coalesce(last_value(a IGNORE NULLS) OVER w, first_value(b IGNORE NULLS) OVER w) AS carried FROM sb WINDOW w AS (PARTITION BY doc_id ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


_TOTAL = r"nullif(regexp_extract({0}, '(?i)available marks\s*[:=]?\s*(\d+)', 1), '')"
#: all_ (doc_id, page, id, marks, text, answer, working, notes, n, place): the parts in order; kept without bare stems; mgd merged.
_DOCUMENT = rf"""{_pages(_CLEAN)},
pgc AS (SELECT page_id, doc_id, page, CASE WHEN carried IS NOT NULL AND regexp_matches(whole, '[^{_WS}]') AND NOT opens THEN carried || ' ' || markdown ELSE markdown END AS markdown FROM ca WHERE NOT front),
{_again(d._PARTS, "c")},
al AS (SELECT s.doc_id, s.page, 0 AS prose, table_no, island AS o, id, marks, working AS text, answer, working, notes FROM scheme s JOIN pgc ON pgc.doc_id = s.doc_id AND pgc.page = s.page
  UNION ALL SELECT doc_id, page, 1, 0, ord, id, marks, text, '', '', '' FROM parts_c),
all_ AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page, prose, table_no, o) AS n, row_number() OVER (PARTITION BY doc_id, page ORDER BY prose, table_no, o) - 1 AS place, count(*) OVER (PARTITION BY doc_id, page) AS on_page FROM al),
kept AS (SELECT * FROM all_ a WHERE NOT (regexp_matches(id, '^\d{{1,2}}$') AND EXISTS (SELECT 1 FROM all_ b WHERE b.doc_id = a.doc_id AND b.id LIKE a.id || '(%'))),
kt AS (SELECT *, TRY_CAST(coalesce({_TOTAL.format('notes')}, {_TOTAL.format('text')}, {_TOTAL.format('answer')}) AS INTEGER) AS total FROM kept),
ag AS (SELECT doc_id, id, min(n) AS first_, arg_min(page, n) AS page, count(*) AS c, max(marks) AS most, arg_max(total, n) FILTER (WHERE total IS NOT NULL) AS total, arg_max(text, struct_pack(l := length(text), o := -n)) FILTER (WHERE regexp_matches(text, '[^{_WS}]')) AS longest, arg_min(text, n) AS only_,
  coalesce(arg_max(answer, n) FILTER (WHERE answer <> ''), '') AS answer, coalesce(string_agg(working, {_NL} ORDER BY n) FILTER (WHERE working <> ''), '') AS working, coalesce(string_agg(notes, {_NL} ORDER BY n) FILTER (WHERE notes <> ''), '') AS notes FROM kt GROUP BY doc_id, id),
mgd AS (SELECT doc_id, id, first_, page, CASE WHEN c = 1 THEN most ELSE coalesce(total, most) END AS marks, CASE WHEN c = 1 THEN only_ ELSE coalesce(longest, working) END AS text, answer, working, notes FROM ag)"""
_FIGURES = d._FIGS.replace(d._PG + ",", "", 1).lstrip()
_INJECTED = rf"""il AS (SELECT *, {_LINES.format(f"regexp_replace(markdown, '^[{_WS}]+', '')")} AS l FROM dec),
ix AS (SELECT *, list_position(list_transform(l, lambda x: NOT ({_JUNK} OR NOT regexp_matches(x, '[^{_WS}]'))), true) AS pos FROM il),
ir AS (SELECT *, regexp_replace(array_to_string(l[pos:], {_NL}), '^[{_WS}]+', '') AS rest FROM ix)"""

# -- OCR responses: the layout in the envelopes that occur, a string of JSON at any of its levels ------------


def _open(c: str) -> str:
    return f"CASE WHEN json_type({c}) = 'VARCHAR' THEN CASE WHEN json_valid({c} ->> '$') THEN CAST({c} ->> '$' AS JSON) END ELSE {c} END"


_RAW = f"""r0 AS (SELECT raw_id, any_value(raw) AS raw FROM ocr_raw GROUP BY raw_id),
r1 AS (SELECT raw_id, CASE WHEN json_valid(raw) THEN CAST(raw AS JSON) END AS j FROM r0),
r2 AS (SELECT raw_id, {_open('j')} AS j FROM r1),
r3 AS (SELECT raw_id, j, {_open("(j -> '$.data')")} AS dt, {_open("(j -> '$.response')")} AS rs FROM r2),
r4 AS (SELECT *, {_open("(rs -> '$.data')")} AS rd FROM r3),
r5 AS (SELECT raw_id, CASE WHEN coalesce(j -> '$.layout_details', j -> '$.layout') IS NOT NULL THEN j WHEN coalesce(dt -> '$.layout_details', dt -> '$.layout') IS NOT NULL THEN dt WHEN coalesce(rd -> '$.layout_details', rd -> '$.layout') IS NOT NULL THEN rd ELSE rs END AS b, j, dt, rs, rd FROM r4),
r6 AS (SELECT *, coalesce(b -> '$.layout_details', b -> '$.layout') AS l0 FROM r5),
r7 AS (SELECT *, {_open('l0')} AS l FROM r6),
x0 AS (SELECT raw_id, unnest(CAST(l AS JSON[])) AS x, generate_subscripts(CAST(l AS JSON[]), 1) AS i FROM r7 WHERE json_type(l) = 'ARRAY'),
x1 AS (SELECT raw_id, i, unnest(CASE json_type(x) WHEN 'ARRAY' THEN CAST(x AS JSON[]) ELSE [x] END) AS x, generate_subscripts(CASE json_type(x) WHEN 'ARRAY' THEN CAST(x AS JSON[]) ELSE [x] END, 1) AS k FROM x0),
e AS (SELECT raw_id, x, CAST(row_number() OVER (PARTITION BY raw_id ORDER BY i, k) AS INTEGER) AS n FROM x1 WHERE json_type(x) = 'OBJECT'),
{{0}}"""


def _inner(source: str, parent: str, out: str) -> str:
    """out (raw_id, up, x, n): the objects of the one list of objects of each record."""
    return f"""{out}0 AS (SELECT raw_id, {parent} AS up, x, unnest(json_keys(x)) AS key, generate_subscripts(json_keys(x), 1) AS pos FROM {source}),
{out}1 AS (SELECT raw_id, up, pos, json_extract(x, '$."' || key || '"') AS v FROM {out}0 WHERE json_type(json_extract(x, '$."' || key || '"')) = 'ARRAY'),
{out}2 AS (SELECT raw_id, up, pos, unnest(CAST(v AS JSON[])) AS x, generate_subscripts(CAST(v AS JSON[]), 1) AS i FROM {out}1),
{out}3 AS (SELECT *, min(pos) OVER (PARTITION BY raw_id, up) AS least_ FROM {out}2 WHERE json_type(x) = 'OBJECT'),
{out} AS (SELECT raw_id, up, x, CAST(row_number() OVER (PARTITION BY raw_id, up ORDER BY i) AS INTEGER) AS n FROM {out}3 WHERE pos = least_)"""


_NODES = f"{_RAW.format(_inner('e', 'CAST(n AS VARCHAR)', 'a'))}, an AS (SELECT raw_id, x, up || '.' || n AS node, up, n FROM a), {_inner('an', 'node', 'b')}"
_TEXT = "coalesce(nullif(CASE WHEN json_type(x -> '$.{0}') = 'VARCHAR' THEN x ->> '$.{0}' END, ''), nullif(CASE WHEN json_type(x -> '$.{1}') = 'VARCHAR' THEN x ->> '$.{1}' END, ''))"
_BOX = "CASE WHEN json_type(x -> '$.bbox_2d') = 'ARRAY' THEN x -> '$.bbox_2d' WHEN json_type(x -> '$.bbox') = 'ARRAY' THEN x -> '$.bbox' WHEN json_type(x -> '$.box') = 'ARRAY' THEN x -> '$.box' END"
_ELEMENTS = f"el AS (SELECT raw_id, n, {_TEXT.format('label', 'type')} AS label, {_TEXT.format('content', 'text')} AS content, TRY_CAST({_BOX} AS DOUBLE[]) AS box FROM e)"
_MD = "coalesce(" + ", ".join(f"nullif(CASE WHEN json_type({{0}} -> '$.{f}') = 'VARCHAR' THEN {{0}} ->> '$.{f}' END, '')" for f in ("md_results", "markdown", "md")) + ")"

# -- reports with the math judged -----------------------------------------------------------

_MI = f"src AS (SELECT dataset_id || ':' || i || ':' || f AS k, v AS value FROM (SELECT dataset_id, i, unnest(['text', 'answer', 'working', 'notes']) AS f, unnest([text, answer, working, notes]) AS v FROM qs) WHERE v <> ''), {_segments('src', 'hs')}, {_balanced('hs', 'is_math', 'hb')}, mi AS (SELECT CAST(split_part(k, ':', 1) AS BIGINT) AS dataset_id, count(*) FILTER (WHERE is_math AND NOT good) AS invalid FROM hb GROUP BY ALL)"
_HEALTH = d._HEALTH.replace(d._QS + ",", f"{d._QS}, {_MI},", 1).replace("0 AS math_invalid", "coalesce(invalid, 0) AS math_invalid").replace("CASE WHEN coalesce(d, 0) + coalesce(bad, 0) > 0 THEN 'FAIL'", "CASE WHEN coalesce(d, 0) + coalesce(bad, 0) + coalesce(invalid, 0) > 0 THEN 'FAIL'").replace("LEFT JOIN dup USING (dataset_id)", "LEFT JOIN dup USING (dataset_id) LEFT JOIN mi USING (dataset_id)")
_META = d._META

SQL = {
    "number_injection": rf"WITH {d._DEC}, {_INJECTED} SELECT page_id, CASE WHEN regexp_matches(markdown, '(?i)CANDIDATE NAME|BLANK PAGE') OR pos IS NULL OR pos = 0 OR regexp_matches(rest, '^\s*(?:\[.*?\]\s*)?\(?\d{{1,2}}(?:$|[^\p{{L}}\p{{N}}_])') THEN markdown ELSE (page_id % 90 + 1) || '. ' || rest END AS markdown FROM ir",
    "carried_numbers": f"WITH {_pages('raw')} SELECT doc_id, page, carried FROM ca",
    "document_parts": f"WITH {_DOCUMENT} SELECT doc_id, id, page, marks, text, answer, working, notes FROM mgd",
    "assembled_datasets": rf"""WITH {_DOCUMENT}, {_FIGURES},
      pf AS (SELECT k.doc_id, k.id FROM big b JOIN kept k ON k.doc_id = b.doc_id AND k.page = b.page AND k.place = CASE WHEN on_page = 1 THEN 0 ELSE floor(least(greatest((y0 + y1) / 2 / greatest(height, 1), 0), 0.999) * on_page) END),
      nf AS (SELECT doc_id, count(*) AS n FROM pf GROUP BY doc_id), np AS (SELECT doc_id, CAST(count(*) AS INTEGER) AS pages FROM pg0 GROUP BY doc_id),
      qn AS (SELECT doc_id, CAST(count(*) AS INTEGER) AS n, sum(coalesce(marks, 0)) AS t, string_agg(id, ' ' ORDER BY first_) AS ids FROM mgd GROUP BY doc_id)
      SELECT doc_id, CASE WHEN regexp_matches(doc_id, '{_META}', 'i') THEN regexp_extract(doc_id, '{_META}', 1, 'i') || '/' || regexp_extract(doc_id, '{_META}', 5, 'i') ELSE '' END AS paper,
        CASE lower(regexp_extract(doc_id, '{_META}', 4, 'i')) WHEN 'ms' THEN 'marking_scheme' WHEN 'qp' THEN 'question_paper' WHEN 'in' THEN 'insert' ELSE 'unknown' END AS kind, pages, coalesce(qn.n, 0) AS n_questions, coalesce(t, 0) AS total_marks, coalesce(ids, '') AS ids, coalesce(nf.n, 0) AS n_diagrams
      FROM np LEFT JOIN qn USING (doc_id) LEFT JOIN nf USING (doc_id)""",
    "health_report": f"WITH {_HEALTH} SELECT * FROM health",
    "verdict_rollup": f"WITH {_HEALTH} SELECT kind, verdict, count(*) AS n, sum(total_marks) AS marks FROM health GROUP BY ALL",
    "worst_verdict": f"WITH {_HEALTH} SELECT CASE max(CASE verdict WHEN 'FAIL' THEN 2 WHEN 'WARN' THEN 1 ELSE 0 END) WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARN' ELSE 'PASS' END AS worst FROM health",
    "p1_found": f"""WITH {_NODES}, ds AS (SELECT dataset_id, q, row_number() OVER (PARTITION BY dataset_id ORDER BY i) AS n FROM (SELECT dataset_id, unnest(questions) AS q, generate_subscripts(questions, 1) AS i FROM (SELECT dataset_id, any_value(questions) AS questions FROM datasets GROUP BY dataset_id)) WHERE q IS NOT NULL),
      pd AS (SELECT part_id, unnest(range(1, len(list_filter(diagrams, lambda x: x IS NOT NULL)) + 1)) AS n FROM (SELECT part_id, any_value(diagrams) AS diagrams FROM parts GROUP BY part_id))
      SELECT 'datasets' AS src, dataset_id AS rec_id, CAST(n AS VARCHAR) AS node FROM ds UNION ALL SELECT 'datasets', dataset_id, n || '.' || unnest(range(1, len(list_filter(q.diagrams, lambda x: x IS NOT NULL)) + 1)) FROM ds
      UNION ALL SELECT 'parts', part_id, CAST(n AS VARCHAR) FROM pd
      UNION ALL SELECT 'ocr_raw', raw_id, CAST(n AS VARCHAR) FROM e UNION ALL SELECT 'ocr_raw', raw_id, node FROM an UNION ALL SELECT 'ocr_raw', raw_id, up || '.' || n FROM b""",
    "p1_elements": f"WITH {_RAW.format(_ELEMENTS)} SELECT raw_id, CAST(n AS VARCHAR) AS node, label, content, box[1] AS x0, box[2] AS y0, box[3] AS x1, box[4] AS y1 FROM el",
    "p1_items": f"WITH {_NODES} SELECT raw_id, node, up AS parent_node, n AS ordinal, {_TEXT.format('t', 'text')} AS text FROM an UNION ALL SELECT raw_id, up || '.' || n, up, n, {_TEXT.format('t', 'text')} FROM b",
    "normalised_responses": f"WITH {_RAW.format(_ELEMENTS)}, ct AS (SELECT raw_id, count(*) FILTER (WHERE len(box) = 4) AS n FROM el GROUP BY raw_id) SELECT raw_id, CAST(length(coalesce({_MD.format('b')}, {_MD.format('j')}, '')) AS INTEGER) AS n_chars, CAST(coalesce(n, 0) AS INTEGER) AS n_elements FROM r7 LEFT JOIN ct USING (raw_id)",
    "response_elements": f"WITH {_RAW.format(_ELEMENTS)} SELECT raw_id, CAST(row_number() OVER (PARTITION BY raw_id ORDER BY n) AS INTEGER) AS n, coalesce(label, 'text') AS label, box[1] AS x0, box[2] AS y0, box[3] AS x1, box[4] AS y1, content FROM el WHERE len(box) = 4",
}
