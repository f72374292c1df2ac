"""SQL of the queries on math, boxes, carried numbers and whole documents, and queries on functions that no other query shows.

The SQL states each result by windows over pieces of text rather than by the steps of the operators.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions import geometry as g
from folioflow.functions import math as m
from folioflow.functions import text as t
from folioflow.operators import datasets as ds
from folioflow.operators import marks
from folioflow.operators import parts as p
from folioflow.plans import documents as d
from folioflow.plans import positions
from folioflow.session import table


def invalid_math(spark: SparkSession, sf: str) -> DataFrame:
    """Math segments of each text, its last brace lost, and how many of them don't balance."""
    broken = F.regexp_replace("value", r"\}([^}]*)\z", "$1")
    segments = m.math_segments(broken)
    return d._texts(spark, sf).select("part_id", "field", F.size(segments).alias("segments"), F.size(F.filter(segments, lambda s: ~m.is_valid(s))).alias("invalid"))


def math_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """The tokens of each line of working, and which of them are math."""
    lines = d._texts(spark, sf).filter("field = 'working'").select("part_id", F.posexplode(F.split("value", "\n", -1)).alias("line_no", "line"))
    rows = lines.select("part_id", "line_no", F.posexplode(F.regexp_extract_all("line", F.lit(r"(?U)\S+"), F.lit(0))).alias("n", "token"))
    return rows.select("part_id", "line_no", "n", "token", m.is_math_token(F.col("token")).alias("is_math"))


def crop_corners(spark: SparkSession, sf: str) -> DataFrame:
    """Pixel corners of every element's box on its page, enlarged so that some reach over the edge."""
    boxes = F.transform(F.filter("elements", lambda e: e["bbox"].isNotNull()), lambda e: g.box(e["bbox"]["x0"] - 20.5, e["bbox"]["y0"] - 20.5, e["bbox"]["x1"] * 1.5, e["bbox"]["y1"] * 1.5))
    rows = d._pages(spark, sf).select("page_id", F.posexplode(F.transform(boxes, lambda b: g.crop_corners(b, F.col("width"), F.col("height")))).alias("i", "b"))
    return rows.select("page_id", (F.col("i") + 1).alias("n"), *[F.col(f"b.{c}").alias(c) for c in g.CORNERS])


def scaled_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Every element's box in points at 200 dots an inch, and in pixels again."""
    rows = d._pages(spark, sf).select("page_id", F.posexplode(F.filter("elements", lambda e: e["bbox"].isNotNull())).alias("i", "e"))
    scale = F.lit(200 / 72)
    rows = rows.withColumn("pt", g.pixels_to_points(F.col("e.bbox"), scale))
    both = [F.round(F.col(f"pt.{c}"), 6).alias(f"pt_{c}") for c in g.CORNERS] + [F.round(g.points_to_pixels(F.col("pt"), scale)[c], 6).alias(f"px_{c}") for c in g.CORNERS]
    return rows.select("page_id", (F.col("i") + 1).alias("n"), *both)


def data_urls(spark: SparkSession, sf: str) -> DataFrame:
    return d._one(spark, sf, "assets", "asset_id").select("asset_id", t.data_url(F.encode("asset_name", "UTF-8")).alias("url"))


def orphan_filled_marks(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of documents whose numbers are left out, with their marks in reading order."""
    third = F.regexp_extract("doc_id", r"\d+", 0).cast("bigint") % 3 == 0
    words = positions.words(spark, sf).filter(third & (F.col("x0") >= 100))
    return marks.fill_orphans(positions._open_parts(spark, sf).filter(third), marks.orphan_marks(words)).select("doc_id", "page", "id", "marks")


def selection_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """The number and marks of each question of the custom paper."""
    rows = ds.select_questions(table(spark, sf, "selections"), ds.question_index(table(spark, sf, "datasets")))
    return ds.markdown_cards(rows).select("no", "sel_no", "m")


def anomaly_lists(spark: SparkSession, sf: str) -> DataFrame:
    """The anomalies of each dataset in order, its first question repeated, and its second again under no id with neither marks nor contents."""
    rows = table(spark, sf, "datasets")
    kept = F.filter("questions", lambda q: q.isNotNull())
    blank = lambda q: F.struct(F.concat(F.lit("Q "), q["id"]).alias("id"), F.lit(None).cast("int").alias("marks"), F.lit(" ").alias("text"), *[q[c].alias(c) for c in ("diagrams", "page")], *[F.lit(None).cast("string").alias(c) for c in ("answer", "working", "notes")])
    rows = rows.withColumn("questions", F.concat(kept, F.slice(kept, 1, 1), F.transform(F.slice(kept, 2, 1), blank)))
    rows = ds.health(rows).select("dataset_id", F.posexplode("anomalies").alias("i", "anomaly"))
    return rows.select("dataset_id", (F.col("i") + 1).alias("n"), "anomaly")


def merged_schemes(spark: SparkSession, sf: str) -> DataFrame:
    """Question parts of datasets merged over all datasets of a paper: longest text, last answer, workings and notes in order, footers."""
    q = ds.questions(table(spark, sf, "datasets")).filter("paper is not null and id is not null")
    order = F.struct(F.col("dataset_id"), F.col("ord"))
    footer = F.when(F.col("dataset_id") % 7 == 0, F.concat(F.coalesce("notes", F.lit("")), F.lit(" Available marks: "), (F.col("dataset_id") % 20).cast("string"))).otherwise(F.coalesce("notes", F.lit("")))
    rows = q.select(F.col("paper").alias("doc_id"), "id", F.coalesce("page", F.lit(0)).alias("page"), order.alias("ord"), "marks", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("answer", F.lit("")).alias("answer"), F.coalesce("working", F.lit("")).alias("working"), footer.alias("notes"))
    return p.merge_parts(rows).select(F.col("doc_id").alias("paper"), "id", "page", "marks", "text", "answer", "working", "notes")


QUERIES = {f.__name__: f for f in (invalid_math, math_tokens, crop_corners, scaled_boxes, data_urls, orphan_filled_marks, selection_numbers, anomaly_lists, merged_schemes)}

# -- SQL: math --------------------------------------------------------------------------

_NL, _TRIM = d._NL, d._TRIM
#: White space inside a class of characters; RE2 has only that of ASCII.
_WS = r"\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_BROKEN_OPENER = r"regexp_replace(value, '(?s)^(.*)\$([^$]*\$[^$]*)$', '\1\2')"
_BROKEN_BRACE = r"regexp_replace(value, '(?s)\}([^}]*)$', '\1')"
_DOLLARS = d._DOLLARS


def _mended(source: str) -> str:
    """md (k, value) out of source (k, value): each line with an even number of dollars."""
    return rf"""mli AS (SELECT k, unnest(string_split(value, {_NL})) AS line, generate_subscripts(string_split(value, {_NL}), 1) AS no FROM {source}),
mlo AS (SELECT *, {_DOLLARS.format("line")} AS n, regexp_extract(line, '^(.*)\$([^$]*)$', 1) AS head, regexp_extract(line, '^(.*)\$([^$]*)$', 2) AS tail FROM mli),
mlr AS (SELECT *, ltrim(regexp_extract(head, '[\p{{L}}\p{{N}}{_WS}\\^_{{}}=+\-*/().,\[\]|<>!]*$'), ' ') AS region FROM mlo),
md AS (SELECT k, string_agg(CASE WHEN n % 2 = 0 THEN line WHEN regexp_matches(region, '\\[a-zA-Z]+|[\^_{{}}=]') THEN left(head, CAST(length(head) - length(region) AS BIGINT)) || '$' || region || '$' || tail ELSE head || tail END, {_NL} ORDER BY no) AS value FROM mlr GROUP BY k)"""


def _segments(source: str, name: str = "sg") -> str:
    """sg (k, i, is_math, content): the pieces between unescaped dollars."""
    parts = r"string_split(replace(value, '\$', chr(1)), '$')"
    return rf"""{name}0 AS (SELECT k, unnest({parts}) AS c, generate_subscripts({parts}, 1) AS i FROM {source}), {name} AS (SELECT k, i, i % 2 = 0 AS is_math, replace(c, chr(1), '\$') AS content FROM {name}0 WHERE c <> '')"""


def _balanced(source: str, only: str = "true", name: str = "bb") -> str:
    """bb (k, i, is_math, content, good): braces balanced, and whether they were. A closer is stray where the depth falls to a new least below zero."""
    pieces = r"regexp_extract_all(content, '[{}]|[^{}]+')"
    return rf"""{name}0 AS (SELECT k, i, unnest({pieces}) AS x, generate_subscripts({pieces}, 1) AS n FROM {source} WHERE {only}),
{name}1 AS (SELECT *, sum(CASE x WHEN '{{' THEN 1 WHEN '}}' THEN -1 ELSE 0 END) OVER (PARTITION BY k, i ORDER BY n) AS depth FROM {name}0),
{name}2 AS (SELECT *, x = '}}' AND depth < least(0, coalesce(min(depth) OVER (PARTITION BY k, i ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS stray FROM {name}1),
{name}3 AS (SELECT k, i, coalesce(string_agg(x, '' ORDER BY n) FILTER (WHERE NOT stray), '') || repeat('}}', CAST(arg_max(depth, n) - least(0, min(depth)) AS BIGINT)) AS content, bool_or(stray) OR arg_max(depth, n) <> least(0, min(depth)) AS bad FROM {name}2 GROUP BY k, i),
{name} AS (SELECT s.k, s.i, s.is_math, coalesce(b.content, s.content) AS content, NOT coalesce(b.bad, false) AS good FROM {source} s LEFT JOIN {name}3 b ON b.k = s.k AND b.i = s.i)"""


def _joined(source: str, name: str = "jn") -> str:
    """jn (k, value): the segments as one text; a space where a letter or digit would touch a dollar."""
    strip = _TRIM.format("content").replace(r"\s", f"[{_WS}]")
    return rf"""{name}0 AS (SELECT k, i, is_math, CASE WHEN is_math THEN '$' || {strip} || '$' ELSE content END AS x FROM {source}),
{name}1 AS (SELECT *, lag(x) OVER (PARTITION BY k ORDER BY i) AS y FROM {name}0),
{name} AS (SELECT k, string_agg(CASE WHEN is_math AND regexp_matches(coalesce(y, ''), '[\p{{L}}\p{{N}}]$') THEN ' ' WHEN NOT is_math AND coalesce(y, '') LIKE '%$' AND regexp_matches(x, '^[\p{{L}}\p{{N}}]') THEN ' ' ELSE '' END || x, '' ORDER BY i) AS value FROM {name}1 GROUP BY k)"""


_PROSE = ", ".join(f"'{w}'" for w in m.PROSE)


def _wrapped(source: str) -> str:
    """wr (k, value): bare math of each line between dollars. Tokens carry the number of their line, of their side and of themselves."""
    sides = r"string_split(replace(line, '\$', chr(1)), '$')"
    token = r"NOT regexp_matches(x, '(?i)^[MAB][0-9]+(ft)?$') AND lower(x) NOT IN (" + _PROSE + r") AND regexp_matches(x, '\\[a-zA-Z]+|[<>=^_]|\p{Nd}')"
    return rf"""wl AS (SELECT k, unnest(string_split(value, {_NL})) AS line, generate_subscripts(string_split(value, {_NL}), 1) AS no FROM {source}),
ws AS (SELECT k, no, unnest({sides}) AS c, generate_subscripts({sides}, 1) AS s FROM wl),
wt AS (SELECT k, no, s, CASE WHEN s % 2 = 0 THEN [replace(c, chr(1), '\$')] ELSE regexp_extract_all(replace(c, chr(1), '\$'), '[^{_WS}]+|[{_WS}]+') END AS ts FROM ws WHERE c <> ''),
wx AS (SELECT k, no, s, unnest(ts) AS x0, generate_subscripts(ts, 1) AS n FROM wt),
wg AS (SELECT k, no, s, n, x0, CASE WHEN s % 2 = 1 AND lower(regexp_extract(x0, '^([a-z]{{2,}})[0-9\-+(\\<>=]', 1)) IN ({_PROSE}) THEN regexp_extract(x0, '^([a-z]{{2,}})[0-9\-+(\\<>=]', 1) ELSE '' END AS h FROM wx),
wu AS (SELECT k, no, s, n, unnest(CASE WHEN h = '' THEN [x0] ELSE [h, ' ', substr(x0, length(h) + 1)] END) AS x, generate_subscripts(CASE WHEN h = '' THEN [x0] ELSE [h, ' ', ''] END, 1) AS u, h FROM wg),
wk AS (SELECT *, CASE WHEN s % 2 = 0 THEN 3 WHEN regexp_matches(x, '^[{_WS}]') THEN 0 WHEN h <> '' AND u = 1 THEN 1 WHEN {token} THEN 2 ELSE 1 END AS kind FROM wu),
wn AS (SELECT *, lag(kind) OVER w AS before, lead(kind) OVER w AS after FROM wk WINDOW w AS (PARTITION BY k, no ORDER BY s, n, u)),
wm AS (SELECT *, kind >= 2 OR (kind = 0 AND before = 2 AND after = 2) AS math FROM wn),
wo AS (SELECT *, CASE WHEN math AND coalesce(lag(math) OVER (PARTITION BY k, no ORDER BY s, n, u), false) THEN 0 ELSE 1 END AS new FROM wm),
wr0 AS (SELECT *, sum(new) OVER (PARTITION BY k, no ORDER BY s, n, u) AS run FROM wo),
wr1 AS (SELECT [CAST(k AS VARCHAR), CAST(no AS VARCHAR)] AS k, any_value(k) AS k0, any_value(no) AS no, run AS i, any_value(math) AS is_math, string_agg(x, '' ORDER BY s, n, u) AS content FROM wr0 GROUP BY ALL),
{_joined("wr1", "wj")},
wz AS (SELECT wl.k, wl.no, coalesce(wj.value, '') AS value FROM wl LEFT JOIN wj ON wj.k = [CAST(wl.k AS VARCHAR), CAST(wl.no AS VARCHAR)]),
wr AS (SELECT k, string_agg(value, {_NL} ORDER BY no) AS value FROM wz GROUP BY k)"""


_SIGNED = d._replaced("value", list(m.SIGNS.items()))
_KEYED = f"{d._TEXTS}, src AS (SELECT part_id || ':' || field AS k, part_id, field, value FROM tx WHERE value IS NOT NULL)"
_OUT = "SELECT s.part_id, s.field, coalesce(x.value, '') AS value FROM src s LEFT JOIN {0} x ON x.k = s.k"
_REPAIR = f"sr AS (SELECT k, {_SIGNED} AS value FROM src), {_mended('sr')}, {_wrapped('md')}, {_segments('wr')}, {_balanced('sg', 'is_math')}, bl AS (SELECT k, i, is_math, CASE WHEN is_math THEN replace(content, {_NL}, ' ') ELSE content END AS content FROM bb), {_joined('bl')}"

MATH = {
    "rejoined_math": f"WITH {_KEYED}, {_segments('src')}, {_joined('sg')} {_OUT.format('jn')}",
    "mended_delimiters": f"WITH {_KEYED}, br AS (SELECT k, {_BROKEN_OPENER} AS value FROM src), {_mended('br')} {_OUT.format('md')}",
    "balanced_braces": f"WITH {_KEYED}, br AS (SELECT k, 1 AS i, true AS is_math, {_BROKEN_BRACE} || '}}}}' AS content FROM src), {_balanced('br')}, fin AS (SELECT k, content AS value FROM bb) {_OUT.format('fin')}",
    "sanitized_math": f"WITH {_KEYED}, sr AS (SELECT k, {_SIGNED} AS value FROM src), {_mended('sr')}, {_segments('md')}, {_balanced('sg', 'is_math')}, {_joined('bb')} {_OUT.format('jn')}",
    "repaired_math": f"WITH {_KEYED}, {_REPAIR} {_OUT.format('jn')}",
    "invalid_math": f"WITH {_KEYED}, br AS (SELECT k, {_BROKEN_BRACE} AS value FROM src), {_segments('br')}, {_balanced('sg', 'is_math')} SELECT s.part_id, s.field, CAST(count(b.k) FILTER (WHERE is_math) AS INTEGER) AS segments, CAST(count(b.k) FILTER (WHERE is_math AND NOT good) AS INTEGER) AS invalid FROM src s LEFT JOIN bb b ON b.k = s.k GROUP BY s.part_id, s.field",
    "math_tokens": rf"WITH {d._TEXTS}, ln AS (SELECT part_id, unnest(string_split(value, {_NL})) AS line, generate_subscripts(string_split(value, {_NL}), 1) - 1 AS line_no FROM tx WHERE field = 'working' AND value IS NOT NULL), tk AS (SELECT part_id, line_no, unnest(l) AS x, generate_subscripts(l, 1) - 1 AS n FROM (SELECT part_id, line_no, regexp_extract_all(line, '[^{_WS}]+') AS l FROM ln)) SELECT part_id, CAST(line_no AS INTEGER) AS line_no, CAST(n AS INTEGER) AS n, x AS token, NOT regexp_matches(x, '(?i)^[MAB][0-9]+(ft)?$') AND lower(x) NOT IN ({_PROSE}) AND regexp_matches(x, '\\[a-zA-Z]+|[<>=^_]|\p{{Nd}}') AS is_math FROM tk",
    "sanitized_datasets": f"WITH {d._QS}, src AS (SELECT dataset_id || ':' || i || ':' || f AS k, dataset_id, i, f, v AS value FROM (SELECT dataset_id, i, unnest(['text', 'answer', 'working', 'notes']) AS f, unnest([text, answer, working, notes]) AS v FROM qs) WHERE v <> ''), {_REPAIR}, "
    "of AS (SELECT s.dataset_id, s.i, s.f, j.value FROM src s JOIN jn j ON j.k = s.k) "
    + "SELECT q.dataset_id, CAST(row_number() OVER (PARTITION BY q.dataset_id ORDER BY q.i) - 1 AS INTEGER) AS ord, q.id, "
    + ", ".join(f"coalesce((SELECT any_value(value) FROM of WHERE of.dataset_id = q.dataset_id AND of.i = q.i AND f = '{f}'), q.{f}) AS {f}" for f in ds.FIELDS)
    + ", CAST(0 AS INTEGER) AS repairs FROM qs q",
}

# -- SQL: boxes, figures, names -----------------------------------------------------------

_ALL_BOXES = f"{d._PG}, el AS (SELECT page_id, width, height, unnest(elements) AS e, generate_subscripts(elements, 1) AS i FROM pg), bx AS (SELECT page_id, width, height, e.bbox AS b, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) AS INTEGER) AS n FROM el WHERE e IS NOT NULL AND e.bbox IS NOT NULL)"
_IOU = "greatest(0.0, least({0}.x1, {1}.x1) - greatest({0}.x0, {1}.x0)) * greatest(0.0, least({0}.y1, {1}.y1) - greatest({0}.y0, {1}.y0))"
_AREA = "({0}.x1 - {0}.x0) * ({0}.y1 - {0}.y0)"


def _iou(a: str, b: str) -> str:
    i = _IOU.format(a, b)
    s = f"{_AREA.format(a)} + {_AREA.format(b)}"
    return f"CASE WHEN {s} - {i} > 0 THEN ({i}) / ({s} - {i}) ELSE 0.0 END"


BOXES = {
    "box_overlaps": f"WITH {_ALL_BOXES}, gr AS (SELECT page_id, n, struct_pack(x0 := b.x0, y0 := b.y0 - (b.y1 - b.y0), x1 := b.x1, y1 := b.y1) AS b FROM bx) SELECT x.page_id, x.n AS n, y.n AS m, round({_iou('x.b', 'y.b')}, 6) AS iou FROM bx x JOIN gr y ON y.page_id = x.page_id AND x.n < y.n",
    "merged_boxes": f"""WITH {d._boxes("('table', 'table_full')")}, ls AS (SELECT page_id, list([struct_pack(x0 := CAST(x0 AS DOUBLE), y0 := CAST(y0 AS DOUBLE), x1 := CAST(x1 AS DOUBLE), y1 := CAST(y1 AS DOUBLE))] ORDER BY n) AS l FROM dn GROUP BY page_id),
      mg AS (SELECT page_id, list_reduce(l, lambda acc, x: CASE WHEN list_contains(list_transform(acc, lambda k: {_iou('k', 'x[1]')} > 0.2), true)
        THEN list_transform(acc, lambda k, i: CASE WHEN i = list_position(list_transform(acc, lambda k: {_iou('k', 'x[1]')} > 0.2), true) THEN struct_pack(x0 := least(k.x0, x[1].x0), y0 := least(k.y0, x[1].y0), x1 := greatest(k.x1, x[1].x1), y1 := greatest(k.y1, x[1].y1)) ELSE k END)
        ELSE list_concat(acc, x) END) AS b FROM ls)
      SELECT page_id, CAST(n AS INTEGER) AS n, round(b.x0, 4) AS x0, round(b.y0, 4) AS y0, round(b.x1, 4) AS x1, round(b.y1, 4) AS y1 FROM (SELECT page_id, unnest(b) AS b, generate_subscripts(b, 1) AS n FROM mg)""",
    "crop_corners": f"WITH {_ALL_BOXES} SELECT page_id, n, "
    + ", ".join(f"greatest(0, least(CAST(round_even({e}, 0) AS INTEGER), {side})) AS {c}" for c, e, side in (("x0", "b.x0 - 20.5", "width"), ("y0", "b.y0 - 20.5", "height"), ("x1", "b.x1 * 1.5", "width"), ("y1", "b.y1 * 1.5", "height")))
    + " FROM bx",
    "scaled_boxes": f"WITH {_ALL_BOXES} SELECT page_id, n, " + ", ".join(f"round(b.{c} * 72 / 200, 6) AS pt_{c}, round(b.{c}, 6) AS px_{c}" for c in g.CORNERS) + " FROM bx",
    "data_urls": "SELECT asset_id, 'data:image/png;base64,' || to_base64(encode(any_value(asset_name))) AS url FROM assets GROUP BY asset_id",
}

# -- SQL: marks, selections, reports ------------------------------------------------------

_QUESTION_ID = r"'^\d{1,2}(\([a-z]+\))*(\((?:i{1,3}|iv|v)\))*$'"
_ANOMALIES = rf"""{d._QS}, q0 AS (SELECT dataset_id, i, coalesce(id, '') AS id, marks, text, answer FROM qs),
an AS (SELECT dataset_id, 0 AS k, min(i) AS i, 0 AS j, 'duplicate id: ' || id || ' (x' || count(*) || ')' AS anomaly FROM q0 GROUP BY dataset_id, id HAVING count(*) > 1
  UNION ALL SELECT dataset_id, 1, i, 0, 'suspicious id: ''' || id || '''' FROM q0 WHERE NOT regexp_matches(id, {_QUESTION_ID})
  UNION ALL SELECT dataset_id, 1, i, 1, 'missing marks: ' || id FROM q0 WHERE marks IS NULL
  UNION ALL SELECT dataset_id, 1, i, 2, 'empty content: ' || id FROM q0 WHERE NOT regexp_matches(coalesce(text, ''), '\S') AND NOT regexp_matches(coalesce(answer, ''), '\S')),
al AS (SELECT dataset_id, CAST(row_number() OVER (PARTITION BY dataset_id ORDER BY k, i, j) AS INTEGER) AS n, anomaly FROM an)"""
_DIRTIED = "nq AS (SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY i) AS r FROM qs), dq AS (SELECT dataset_id, i, id, marks, text, answer FROM nq UNION ALL SELECT dataset_id, 1000000, id, marks, text, answer FROM nq WHERE r = 1 UNION ALL SELECT dataset_id, 1000001, 'Q ' || id, NULL, ' ', NULL FROM nq WHERE r = 2), "
_PICKED = f"""{d._SEL}, pk AS (SELECT s.sel_no, s.paper, s.id, i.marks, i.text, i.dataset_id, coalesce(i.marks, 0) AS m, row_number() OVER (ORDER BY s.sel_no) AS no FROM sel s JOIN idx i ON i.paper = s.paper AND i.id = s.id),
fg AS (SELECT dataset_id, id, i, unnest(diagrams) AS f, generate_subscripts(diagrams, 1) AS k FROM (SELECT dataset_id, q.id AS id, q.diagrams AS diagrams, i FROM (SELECT dataset_id, unnest(questions) AS q, generate_subscripts(questions, 1) AS i FROM (SELECT dataset_id, any_value(questions) AS questions FROM datasets GROUP BY dataset_id)) WHERE q IS NOT NULL)),
fl AS (SELECT dataset_id, id, i, string_agg(chr(10) || chr(10) || '![diagram](' || f || ')', '' ORDER BY k) FILTER (WHERE f IS NOT NULL) AS figs, bool_or(f IS NULL) AS gap FROM fg GROUP BY ALL),
ff AS (SELECT dataset_id, id, arg_max(figs, i) AS figs FROM fl GROUP BY dataset_id, id)"""


def _esc(c: str) -> str:
    return d._replaced(c, [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")])


REPORTS = {
    "orphan_filled_marks": f"""WITH {positions._B}, om AS (SELECT doc_id, page, mark, y, x FROM b WHERE o_custkey % 3 = 0 UNION ALL SELECT doc_id, page, 9, 5.0, 400.0 FROM o WHERE no = 1 AND o_custkey % 3 = 0),
      r AS (SELECT doc_id, page, mark, row_number() OVER (PARTITION BY doc_id, page ORDER BY y, x) AS i FROM om), q AS (SELECT doc_id, page, no, unnest(CASE WHEN no % 5 = 0 THEN [0] ELSE [1, 2, 3] END) AS k FROM o WHERE o_custkey % 3 = 0),
      w AS (SELECT *, CASE WHEN no % 4 = 0 AND k = 1 THEN 99 END AS own FROM q), v AS (SELECT *, sum(CASE WHEN own IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page ORDER BY no, k) AS i FROM w)
      SELECT v.doc_id, v.page, CASE WHEN k = 0 THEN CAST(no AS VARCHAR) ELSE no || '(' || chr(CAST(96 + k AS INTEGER)) || ')' END AS id, coalesce(own, mark) AS marks FROM v LEFT JOIN r ON own IS NULL AND r.doc_id = v.doc_id AND r.page = v.page AND r.i = v.i""",
    "selection_numbers": f"WITH {_PICKED} SELECT CAST(no AS INTEGER) AS no, sel_no, m FROM pk",
    "anomaly_lists": f"WITH {_ANOMALIES.replace('q0 AS (', _DIRTIED + 'q0 AS (').replace('answer FROM qs)', 'answer FROM dq)')} SELECT dataset_id, n, anomaly FROM al",
    "custom_paper_markdown": f"""WITH {_PICKED} SELECT '# Custom Paper' || {_NL} || {_NL} || string_agg('## ' || no || '. (' || p.paper || ' ' || p.id || ')  [' || m || ' marks]' || {_NL} || {_NL} || coalesce(text, '') || coalesce(figs, '') || {_NL}, {_NL} ORDER BY no) || {_NL} || '---' || {_NL} || '**Total: ' || sum(m) || ' marks**' AS markdown
      FROM pk p LEFT JOIN ff ON ff.dataset_id = p.dataset_id AND coalesce(ff.id, '') = p.id""",
    "custom_paper_html": f"""WITH {_PICKED} SELECT '<!doctype html>' || {_NL} || '<html><head><meta charset="utf-8"><title>Custom Paper</title></head>' || {_NL} || '<body><h1>Custom Paper</h1>' ||
      string_agg('<div class="q"><div class="qh"><span>Q' || no || ' &middot; ' || {_esc('paper')} || ' ' || {_esc('id')} || '</span><span class="mk">[' || m || ' marks]</span></div><div class="qb">' || {_esc("coalesce(text, '')")} || '</div></div>', '' ORDER BY no) || {_NL} || '<p><strong>Total: ' || sum(m) || ' marks</strong></p>' || {_NL} || '</body></html>' AS html FROM pk""",
    "health_texts": f"""WITH {d._HEALTH.strip()}, {_ANOMALIES.replace(d._QS + ",", "", 1).lstrip()},
      ls AS (SELECT dataset_id, string_agg({_NL} || '    ! ' || anomaly, '' ORDER BY n) FILTER (WHERE n <= 12) AS lines, max(n) AS most FROM al GROUP BY dataset_id)
      SELECT h.dataset_id, '[' || verdict || '] ' || paper || ' (' || kind || '): ' || questions || ' questions, ' || total_marks || ' marks, math not validated (' || CAST(math_segments - math_invalid AS BIGINT) || '/' || CAST(math_segments AS BIGINT) || ' with balanced braces), ' || fallbacks || ' fallbacks' || coalesce(lines, '') || CASE WHEN most > 12 THEN {_NL} || '    ... +' || (most - 12) || ' more' ELSE '' END AS report
      FROM health h LEFT JOIN ls USING (dataset_id)""",
    "merged_schemes": rf"""WITH {d._QS}, r AS (SELECT paper, id, dataset_id, i, coalesce(page, 0) AS page, marks, coalesce(text, '') AS text, coalesce(answer, '') AS answer, coalesce(working, '') AS working, CASE WHEN dataset_id % 7 = 0 THEN coalesce(notes, '') || ' Available marks: ' || dataset_id % 20 ELSE coalesce(notes, '') END AS notes FROM qs WHERE paper IS NOT NULL AND id IS NOT NULL),
      f AS (SELECT *, row_number() OVER (PARTITION BY paper, id ORDER BY dataset_id, i) AS n, TRY_CAST(coalesce(nullif(regexp_extract(notes, '(?i)available marks\s*[:=]?\s*(\d+)', 1), ''), nullif(regexp_extract(text, '(?i)available marks\s*[:=]?\s*(\d+)', 1), ''), nullif(regexp_extract(answer, '(?i)available marks\s*[:=]?\s*(\d+)', 1), '')) AS INTEGER) AS total FROM r),
      a AS (SELECT paper, id, arg_min(page, n) AS page, count(*) AS c, max(marks) AS most, arg_max(total, n) FILTER (WHERE total IS NOT NULL) AS total, arg_max(text, struct_pack(l := length(text), o := -n)) FILTER (WHERE regexp_matches(text, '\S')) AS longest, arg_min(text, n) AS only_, coalesce(arg_max(answer, n) FILTER (WHERE answer <> ''), '') AS answer,
        coalesce(string_agg(working, {_NL} ORDER BY n) FILTER (WHERE working <> ''), '') AS working, coalesce(string_agg(notes, {_NL} ORDER BY n) FILTER (WHERE notes <> ''), '') AS notes FROM f GROUP BY paper, id)
      SELECT paper, id, page, CASE WHEN c = 1 THEN most ELSE coalesce(total, most) END AS marks, CASE WHEN c = 1 THEN only_ ELSE coalesce(longest, working) END AS text, answer, working, notes FROM a""",
    "dataset_markdown": f"""WITH one AS (SELECT dataset_id, any_value(paper) AS paper, any_value(kind) AS kind, any_value(source_pdf) AS source_pdf, any_value(series) AS series, any_value(pages) AS pages, any_value(questions) AS questions FROM datasets GROUP BY dataset_id),
      qq AS (SELECT dataset_id, unnest(questions) AS q, generate_subscripts(questions, 1) AS i FROM one),
      md AS (SELECT dataset_id, i, coalesce(q.marks, 0) AS m, {_NL} || '## ' || coalesce(q.id, '') || '  (' || coalesce(CAST(q.marks AS VARCHAR), 'None') || ' marks)' || {_NL} ||
        CASE WHEN coalesce(q.working, '') <> '' THEN {_NL} || '**Working:**' || {_NL} || {_NL} || q.working || {_NL} ELSE '' END ||
        CASE WHEN coalesce(q.answer, '') <> '' AND q.answer IS DISTINCT FROM q.working THEN {_NL} || '**Answer:** ' || q.answer || {_NL} ELSE '' END ||
        CASE WHEN coalesce(q.notes, '') <> '' THEN {_NL} || '**Guidance:** ' || q.notes || {_NL} ELSE '' END ||
        CASE WHEN coalesce(q.working, '') = '' AND coalesce(q.answer, '') = '' THEN {_NL} || coalesce(q.text, '') || {_NL} ELSE '' END ||
        coalesce(array_to_string(list_transform(list_filter(q.diagrams, lambda f: f IS NOT NULL), lambda f: {_NL} || '![diagram](' || f || ')' || {_NL}), ''), '') AS x FROM qq WHERE q IS NOT NULL),
      ag AS (SELECT dataset_id, count(*) AS n, sum(m) AS t, string_agg(x, '' ORDER BY i) AS body FROM md GROUP BY dataset_id)
      SELECT o.dataset_id, '# ' || coalesce(paper, '') || ' — ' || coalesce(kind, '') || {_NL} || {_NL} || '- source_pdf: `' || coalesce(source_pdf, '') || '`' || {_NL} || '- series: ' || coalesce(series, '') || {_NL} || '- pages: ' || coalesce(CAST(pages AS VARCHAR), '') || {_NL} || '- questions: ' || coalesce(n, 0) || {_NL} || '- total_marks: ' || coalesce(t, 0) || {_NL} || {_NL} || '---' || {_NL} || coalesce(body, '') AS markdown FROM one o LEFT JOIN ag USING (dataset_id)""",
}

SQL = {**MATH, **BOXES, **REPORTS}
