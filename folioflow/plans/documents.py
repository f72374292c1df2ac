"""Queries over scanned pages, parts and datasets, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions import geometry as g
from folioflow.functions import math as m
from folioflow.functions import text as t
from folioflow.operators import datasets as ds
from folioflow.operators import parts as p
from folioflow.operators import layout, tables, validate
from folioflow.session import table


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return p.distinct_pages(table(spark, d, "ocr_pages"))


def _one(spark: SparkSession, d: str, name: str, key: str) -> DataFrame:
    return table(spark, d, name).dropDuplicates([key])


# -- pages and lines -------------------------------------------------------------


def _decorated(spark: SparkSession, d: str) -> DataFrame:
    """Every page with front matter, junk lines or nothing added, by its key."""
    k = F.col("page_id") % 4
    head = F.when(k == 0, "Candidate name\n").when(k == 1, " ![](page=3,bbox=[1, 2, 3, 4]) \n").when(k == 2, "$![](page=7)$\n[Turn over]\n").otherwise("")
    return _pages(spark, d).filter("markdown is not null").select("page_id", F.concat(head, "markdown").alias("markdown"))


def front_matter(spark: SparkSession, d: str) -> DataFrame:
    return _decorated(spark, d).select("page_id", t.is_front_matter(F.col("markdown")).alias("front_matter"))


def clean_lines(spark: SparkSession, d: str) -> DataFrame:
    return _decorated(spark, d).select("page_id", t.clean_junk(F.col("markdown")).alias("markdown"))


def page_lines(spark: SparkSession, d: str) -> DataFrame:
    rows = _pages(spark, d).select("page_id", F.posexplode(t.lines(F.col("markdown"))).alias("i", "line"))
    return rows.select("page_id", (F.col("i") + 1).alias("line_no"), "line")


def meaningful_text(spark: SparkSession, d: str) -> DataFrame:
    return _decorated(spark, d).select("page_id", t.meaningful_length(F.col("markdown")).alias("n"))


def number_injection(spark: SparkSession, d: str) -> DataFrame:
    numbers = F.array(F.struct((F.col("page_id") % 90 + 5).alias("n"), F.lit(70.0).alias("y")), F.struct((F.col("page_id") % 90 + 1).alias("n"), F.lit(20.0).alias("y")))
    return _decorated(spark, d).select("page_id", t.inject_number(F.col("markdown"), numbers).alias("markdown"))


# -- questions and parts ------------------------------------------------------------


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d).select("page_id", "doc_id", "page", F.posexplode(t.question_blocks(F.col("markdown"))).alias("i", "b"))


def question_blocks(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, d).select("page_id", (F.col("i") + 1).alias("block_no"), "b.number", "b.text")


def _prose(spark: SparkSession, d: str) -> DataFrame:
    rows = _pages(spark, d).select("page_id", "doc_id", "page", F.posexplode(t.prose_parts(F.col("markdown"))).alias("i", "q"))
    return rows.select("page_id", "doc_id", "page", (F.col("i") + 1).alias("ord"), "q.id", "q.marks", "q.text")


def question_parts(spark: SparkSession, d: str) -> DataFrame:
    return _prose(spark, d).select("page_id", "ord", "id", "marks", "text")


def merged_parts(spark: SparkSession, d: str) -> DataFrame:
    rows = _prose(spark, d).withColumns({c: F.lit("") for c in ("answer", "working", "notes")})
    rows = rows.withColumn("ord", p.order(F.col("page"), 1, F.lit(0), F.col("ord")))
    return p.merge_parts(rows).select("doc_id", "id", "page", "marks", "text")


def paper_totals(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: parts and marks of each document, from its pages' text to merged parts."""
    return merged_parts(spark, d).groupBy("doc_id").agg(F.count("*").alias("parts"), F.sum(F.coalesce("marks", F.lit(0))).alias("total_marks"))


def document_parts(spark: SparkSession, d: str) -> DataFrame:
    return p.merge_parts(p.drop_stems(p.document_parts(table(spark, d, "ocr_pages")))).drop("ord")


def carried_numbers(spark: SparkSession, d: str) -> DataFrame:
    return p.carried_numbers(_pages(spark, d).select("doc_id", "page", F.coalesce("markdown", F.lit("")).alias("markdown")))


def assembled_datasets(spark: SparkSession, d: str) -> DataFrame:
    rows = p.datasets(table(spark, d, "ocr_pages"))
    ids = F.array_join(F.transform("questions", lambda q: q["id"]), " ").alias("ids")
    total = F.aggregate("questions", F.lit(0).cast("bigint"), lambda a, q: a + F.coalesce(q["marks"], F.lit(0))).alias("total_marks")
    figures = F.aggregate("questions", F.lit(0).cast("bigint"), lambda a, q: a + F.size(q["diagrams"])).alias("n_diagrams")
    return rows.select("doc_id", "paper", "kind", "pages", F.size("questions").alias("n_questions"), total, ids, figures)


def dropped_stems(spark: SparkSession, d: str) -> DataFrame:
    parts = _one(spark, d, "parts", "part_id").select("doc_id", "part_id", "id")
    return p.drop_stems(parts).select("part_id", "doc_id", "id")


def stem_parts(spark: SparkSession, d: str) -> DataFrame:
    parts = _one(spark, d, "parts", "part_id")
    return parts.select("part_id", t.is_stem(F.col("id")).alias("stem"), t.question_number(F.col("id")).alias("number"), F.col("id").rlike(ds.QUESTION_ID).alias("valid"))


# -- tables ----------------------------------------------------------------------------


def table_cells(spark: SparkSession, d: str) -> DataFrame:
    rows = tables.table_rows(_pages(spark, d)).select("doc_id", "page", "table_no", "row_no", F.posexplode("cells").alias("col_no", "cell"))
    return rows


def markscheme_parts(spark: SparkSession, d: str) -> DataFrame:
    parts = tables.scheme_parts(tables.table_rows(_pages(spark, d)))
    return parts.select("doc_id", "page", "table_no", F.col("island").cast("int").alias("island"), "id", "marks", "answer", "working", "notes")


def spliced_tables(spark: SparkSession, d: str) -> DataFrame:
    rescued = F.when(F.col("page_id") % 3 == 0, F.array(F.lit("<table>new</table>"))).when(F.col("page_id") % 3 == 1, F.array(F.lit(" "), F.lit("<table>more</table>"))).otherwise(F.array().cast("array<string>"))
    return _pages(spark, d).filter("markdown is not null").select("page_id", tables.splice(F.col("markdown"), rescued).alias("markdown"))


# -- layout -----------------------------------------------------------------------------


def layout_elements(spark: SparkSession, d: str) -> DataFrame:
    rows = _pages(spark, d).select("page_id", F.posexplode("elements").alias("i", "e")).filter("e is not null")
    return rows.select("page_id", (F.col("i") + 1).alias("n"), F.lower("e.label").alias("label"), g.is_table(F.col("e.label")).alias("is_table"), g.is_image(F.col("e.label")).alias("is_image"))


def denormalised_boxes(spark: SparkSession, d: str) -> DataFrame:
    found = g.denormalised(g.boxes_of(F.col("elements"), g.is_table), F.col("width"), F.col("height"))
    rows = _pages(spark, d).select("page_id", F.posexplode(found).alias("i", "b"))
    return rows.select("page_id", (F.col("i") + 1).alias("n"), *[F.round(F.col(f"b.{c}"), 4).alias(c) for c in g.CORNERS])


def box_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Overlap of each box with every later one of its page, the later one grown by its height upwards so that some do."""
    boxes = F.transform(F.filter("elements", lambda e: e["bbox"].isNotNull()), lambda e: e["bbox"])
    rows = _pages(spark, d).select("page_id", boxes.alias("boxes")).select("page_id", "boxes", F.posexplode("boxes").alias("i", "a"))
    rows = rows.select("page_id", "i", "a", F.posexplode("boxes").alias("j", "b")).filter("i < j")
    b = F.col("b")
    grown = g.box(b["x0"], b["y0"] - (b["y1"] - b["y0"]), b["x1"], b["y1"])
    return rows.select("page_id", (F.col("i") + 1).alias("n"), (F.col("j") + 1).alias("m"), F.round(g.iou(F.col("a"), grown), 6).alias("iou"))


def merged_boxes(spark: SparkSession, d: str) -> DataFrame:
    found = g.merged(g.denormalised(g.boxes_of(F.col("elements"), g.is_table), F.col("width"), F.col("height")))
    rows = _pages(spark, d).select("page_id", F.posexplode(found).alias("i", "b"))
    return rows.select("page_id", (F.col("i") + 1).alias("n"), *[F.round(F.col(f"b.{c}"), 4).alias(c) for c in g.CORNERS])


def rescue_regions(spark: SparkSession, d: str) -> DataFrame:
    return layout.rescue_regions(_pages(spark, d)).select("page_id", "region_no", "rescue", F.round("box.y0", 4).alias("y0"))


def large_figures(spark: SparkSession, d: str) -> DataFrame:
    rows = _pages(spark, d).select("page_id", "doc_id", "page", "width", "height", F.posexplode(g.large_figures(F.col("elements"), F.col("width"), F.col("height"))).alias("i", "b"))
    area = F.round(g.area_fraction(F.col("b"), F.col("width"), F.col("height")), 6)
    return rows.select("page_id", (F.col("i") + 1).alias("fig_no"), t.asset_name(F.col("doc_id"), F.col("page"), F.col("i") + 1).alias("asset"), area.alias("area"))


def attached_figures(spark: SparkSession, d: str) -> DataFrame:
    rows = p.attach_figures(_prose(spark, d).select("doc_id", "page", "ord", "id"), _pages(spark, d))
    return rows.select("doc_id", "page", "part_no", "id", "fig_no", "asset")


# -- math -----------------------------------------------------------------------------


def _texts(spark: SparkSession, d: str) -> DataFrame:
    """(part_id, field, value) of the four text fields."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in ds.FIELDS])).alias("x")
    return _one(spark, d, "parts", "part_id").select("part_id", pairs).select("part_id", "x.field", "x.value").filter("value is not null")


def replaced_signs(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).select("part_id", "field", m.replace_signs(F.col("value")).alias("value"))


def dollar_counts(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).select("part_id", "field", m.dollars(F.col("value")).alias("n"))


def math_segments(spark: SparkSession, d: str) -> DataFrame:
    rows = _texts(spark, d).select("part_id", "field", F.posexplode(m.split_math(F.col("value"))).alias("i", "s"))
    return rows.select("part_id", "field", (F.col("i") + 1).alias("n"), "s.is_math", "s.content")


def rejoined_math(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).select("part_id", "field", m.join_segments(m.split_math(F.col("value"))).alias("value"))


def mended_delimiters(spark: SparkSession, d: str) -> DataFrame:
    """Each text with the opening `$` of its last formula lost."""
    broken = F.regexp_replace("value", r"(?s)^(.*)\$([^$]*\$[^$]*)\z", "$1$2")
    return _texts(spark, d).select("part_id", "field", m.mend_delimiters(broken).alias("value"))


def balanced_braces(spark: SparkSession, d: str) -> DataFrame:
    broken = F.concat(F.regexp_replace("value", r"\}([^}]*)\z", "$1"), F.lit("}}"))
    return _texts(spark, d).select("part_id", "field", m.balance_braces(broken).alias("value"))


def repaired_math(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).select("part_id", "field", m.join_segments(m.repair_segments(F.col("value"))).alias("value"))


def sanitized_math(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).select("part_id", "field", m.sanitize(F.col("value")).alias("value"))


def escaped_html(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).select("part_id", "field", t.html_escape(F.col("value")).alias("value"))


def literal_text(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).select("part_id", "field", m.escape_for_text(F.col("value")).alias("value"))


# -- names -------------------------------------------------------------------------------


def filename_meta(spark: SparkSession, d: str) -> DataFrame:
    rows = _one(spark, d, "sources", "source_id").select("source_id", t.parse_filename(F.col("source_pdf")).alias("f"))
    return rows.select("source_id", "f.subject", "f.series", "f.kind", F.col("f.paper").alias("paper"), "f.variant")


def asset_names(spark: SparkSession, d: str) -> DataFrame:
    rows = _one(spark, d, "assets", "asset_id")
    stem = t.safe_stem(F.concat(F.lit("/srv/in put/"), "doc_id", F.lit(".pdf")))
    return rows.select("asset_id", t.asset_name(stem, F.col("page"), F.col("fig_no")).alias("name"), t.media_type(F.col("asset_name")).alias("media_type"))


def cache_keys(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, "ocr_raw", "raw_id").select("raw_id", t.cache_key(F.col("doc_id"), F.col("page"), F.concat(F.lit("pass"), "pass_no")).alias("key"))


def cache_misses(spark: SparkSession, d: str) -> DataFrame:
    """Pages of registered sources without a usable response: what an OCR run has still to ask for."""
    want = _one(spark, d, "sources", "source_id").select("doc_id", F.explode(F.sequence(F.lit(1), "pages")).alias("page")).distinct()
    have = table(spark, d, "ocr_raw").filter("raw is not null").select("doc_id", "page").distinct()
    return want.join(have, ["doc_id", "page"], "left_anti")


# -- datasets ------------------------------------------------------------------------------


def question_index(spark: SparkSession, d: str) -> DataFrame:
    return ds.question_index(table(spark, d, "datasets")).select("paper", "id", "dataset_id", "series", "kind", "marks", "text", "page")


def built_paper(spark: SparkSession, d: str) -> DataFrame:
    rows = ds.select_questions(table(spark, d, "selections"), ds.question_index(table(spark, d, "datasets")))
    return rows.select("sel_no", "paper", "id", "found", "marks", "text")


def missing_selections(spark: SparkSession, d: str) -> DataFrame:
    return ds.missing_selections(table(spark, d, "selections"), ds.question_index(table(spark, d, "datasets")))


def build_summary(spark: SparkSession, d: str) -> DataFrame:
    return ds.build_summary(ds.select_questions(table(spark, d, "selections"), ds.question_index(table(spark, d, "datasets"))))


def custom_paper_markdown(spark: SparkSession, d: str) -> DataFrame:
    return ds.paper_markdown(ds.select_questions(table(spark, d, "selections"), ds.question_index(table(spark, d, "datasets"))))


def custom_paper_html(spark: SparkSession, d: str) -> DataFrame:
    return ds.paper_html(ds.select_questions(table(spark, d, "selections"), ds.question_index(table(spark, d, "datasets"))))


def health_report(spark: SparkSession, d: str) -> DataFrame:
    rep = ds.health(table(spark, d, "datasets"))
    return rep.select("dataset_id", "paper", "kind", "questions", "total_marks", "math_segments", "math_invalid", "fallbacks", F.size("anomalies").alias("n_anomalies"), "verdict")


def health_texts(spark: SparkSession, d: str) -> DataFrame:
    return ds.health(table(spark, d, "datasets")).select("dataset_id", ds.report_text().alias("report"))


def duplicate_ids(spark: SparkSession, d: str) -> DataFrame:
    q = ds.questions(table(spark, d, "datasets"))
    return q.groupBy("dataset_id", "id").agg(F.count("*").alias("n")).filter("n > 1")


def verdict_rollup(spark: SparkSession, d: str) -> DataFrame:
    return health_report(spark, d).groupBy("kind", "verdict").agg(F.count("*").alias("n"), F.sum("total_marks").alias("marks"))


def worst_verdict(spark: SparkSession, d: str) -> DataFrame:
    level = F.when(F.col("verdict") == "FAIL", 2).when(F.col("verdict") == "WARN", 1).otherwise(0)
    return health_report(spark, d).agg(F.max(level).alias("level")).select(F.element_at(F.array(F.lit("PASS"), F.lit("WARN"), F.lit("FAIL")), F.coalesce("level", F.lit(0)) + 1).alias("worst"))


def question_paper_against_scheme(spark: SparkSession, d: str) -> DataFrame:
    """Marks of each part in the question paper and in the marking scheme of its paper and series."""
    q = ds.questions(table(spark, d, "datasets")).filter("paper is not null and series is not null and id is not null")
    by = lambda kind, c: q.filter(F.col("kind") == kind).groupBy("paper", "series", "id").agg(F.max("marks").alias(c))
    both = by("question_paper", "asked").join(by("marking_scheme", "given"), ["paper", "series", "id"])
    return both.select("paper", "series", "id", "asked", "given", F.coalesce(F.col("asked") == F.col("given"), F.lit(False)).alias("equal"))


def sanitized_datasets(spark: SparkSession, d: str) -> DataFrame:
    """Every question with its texts repaired, and how many of its dataset's formulas became literal text."""
    rows = validate.sanitized_datasets(table(spark, d, "datasets"))
    rows = rows.select("dataset_id", F.size("latex_repairs").alias("repairs"), F.posexplode("questions").alias("ord", "q"))
    return rows.select("dataset_id", "ord", "q.id", *[F.col(f"q.{f}").alias(f) for f in ds.FIELDS], "repairs")


def dataset_markdown(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, "datasets", "dataset_id").select("dataset_id", ds.dataset_markdown().alias("markdown"))


QUERIES = {
    f.__name__: f
    for f in (
        paper_totals, front_matter, clean_lines, page_lines, meaningful_text, number_injection, question_blocks, question_parts, merged_parts, document_parts, carried_numbers,
        assembled_datasets, dropped_stems, stem_parts, table_cells, markscheme_parts, spliced_tables, layout_elements, denormalised_boxes, box_overlaps, merged_boxes, rescue_regions, large_figures,
        attached_figures, replaced_signs, dollar_counts, math_segments, rejoined_math, mended_delimiters, balanced_braces, repaired_math, sanitized_math, escaped_html, literal_text,
        filename_meta, asset_names, cache_keys, cache_misses, question_index, built_paper, missing_selections, build_summary, custom_paper_markdown, custom_paper_html, health_report,
        health_texts, duplicate_ids, verdict_rollup, worst_verdict, question_paper_against_scheme, dataset_markdown, sanitized_datasets,
    )
}

# -- SQL ------------------------------------------------------------------------------------

_NL = "chr(10)"
_PG = "pg AS (SELECT page_id, any_value(doc_id) AS doc_id, any_value(page) AS page, any_value(width) AS width, any_value(height) AS height, any_value(markdown) AS markdown, any_value(elements) AS elements FROM ocr_pages GROUP BY page_id)"
_DEC = f"""{_PG}, dec AS (SELECT page_id, markdown AS original, CASE page_id % 4 WHEN 0 THEN 'Candidate name' || {_NL} WHEN 1 THEN ' ![](page=3,bbox=[1, 2, 3, 4]) ' || {_NL}
  WHEN 2 THEN '$![](page=7)$' || {_NL} || '[Turn over]' || {_NL} ELSE '' END || markdown AS markdown FROM pg WHERE markdown IS NOT NULL)"""
_TRIM = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_OPEN = r"^\s*(?:Q(?:uestion)?\s*)?(\d{1,2})(?:$|[^\p{L}\p{N}_])"  # RE2's \b knows ASCII only
_OPENER = r"^\s*(?:Q(?:uestion)?\s*)?\d{1,2}"
_LAB = r"^\s*\(?([a-z]|(?:i{1,3}|iv|v))\s*\)"
_BLOCKS = rf"""{_PG},
ln AS (SELECT page_id, doc_id, page, unnest(string_split(markdown, {_NL})) AS line, generate_subscripts(string_split(markdown, {_NL}), 1) AS no FROM pg),
op AS (SELECT *, regexp_matches(line, '{_OPEN}', 'i') AS opens FROM ln),
bl AS (SELECT *, count(*) FILTER (WHERE opens) OVER (PARTITION BY page_id ORDER BY no) AS block_no FROM op),
blocks AS (SELECT page_id, any_value(doc_id) AS doc_id, any_value(page) AS page, block_no, max(CASE WHEN opens THEN regexp_extract(line, '{_OPEN}', 1, 'i') END) AS number,
  {_TRIM.format(f"string_agg(CASE WHEN opens THEN trim(regexp_replace(line, '{_OPENER}[" + chr(92) + "s.)]*', '', 'i')) ELSE line END, " + _NL + " ORDER BY no)")} AS text
  FROM bl WHERE block_no > 0 GROUP BY page_id, block_no)"""
_PARTS = rf"""{_BLOCKS},
pl AS (SELECT page_id, doc_id, page, block_no, number, unnest(string_split(text, {_NL})) AS line, generate_subscripts(string_split(text, {_NL}), 1) AS no FROM blocks WHERE text <> ''),
po AS (SELECT *, regexp_matches(line, '{_LAB}', 'i') AS opens FROM pl),
pn AS (SELECT *, count(*) FILTER (WHERE opens) OVER (PARTITION BY page_id, block_no ORDER BY no) AS k FROM po),
pt AS (SELECT page_id, any_value(doc_id) AS doc_id, any_value(page) AS page, block_no, k, any_value(number) AS number, lower(max(CASE WHEN opens THEN regexp_extract(line, '{_LAB}', 1, 'i') END)) AS label,
  {_TRIM.format(f"string_agg(CASE WHEN opens THEN trim(regexp_replace(line, '{_LAB}" + chr(92) + "s*', '', 'i')) ELSE line END, " + _NL + " ORDER BY no)")} AS text
  FROM pn GROUP BY page_id, block_no, k),
parts_ AS (SELECT page_id, doc_id, page, CAST(row_number() OVER (PARTITION BY page_id ORDER BY block_no, k) AS INTEGER) AS ord, CASE WHEN label IS NULL THEN number ELSE number || '(' || label || ')' END AS id,
  TRY_CAST(regexp_extract(regexp_extract(text, '(?i)\[\d{{1,2}}\]|\(\d{{1,2}}\s*marks?\)|\b\d{{1,2}}\s*marks?\b'), '\d{{1,2}}') AS INTEGER) AS marks, text FROM pt)"""
_MERGED = f"""{_PARTS},
merged AS (SELECT doc_id, id, arg_min(page, page * 1000000 + ord) AS page, max(marks) AS marks,
  CASE WHEN count(*) = 1 THEN min(text) ELSE coalesce(arg_max(text, struct_pack(n := length(text), o := -(page * 1000000 + ord))) FILTER (WHERE regexp_matches(text, '\\S')), '') END AS text
  FROM parts_ GROUP BY doc_id, id)"""
_CELLS = rf"""{_PG},
tb AS (SELECT doc_id, page, unnest(regexp_extract_all(markdown, '(?is)<table\b.*?</table>')) AS html, generate_subscripts(regexp_extract_all(markdown, '(?is)<table\b.*?</table>'), 1) - 1 AS table_no FROM pg),
rw AS (SELECT doc_id, page, table_no, unnest(regexp_extract_all(html, '(?is)<tr\b[^>]*>(.*?)</tr>', 1)) AS html, generate_subscripts(regexp_extract_all(html, '(?is)<tr\b[^>]*>(.*?)</tr>', 1), 1) - 1 AS row_no FROM tb),
rc AS (SELECT doc_id, page, table_no, row_no, list_transform(regexp_extract_all(html, '(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>', 1), lambda x: {_TRIM.format("replace(replace(replace(replace(regexp_replace(x, '(?i)<br */?>', chr(10), 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&amp;', '&')")}) AS cells FROM rw)"""
_SCHEME = rf"""{_CELLS},
hd AS (SELECT doc_id, page, table_no, list_transform(cells, lambda x: lower(x)) AS header FROM rc WHERE row_no = 0),
nm AS (SELECT r.doc_id, r.page, r.table_no, r.row_no, r.cells[list_position(h.header, 'question')] AS id, r.cells[list_position(h.header, 'answer')] AS answer, r.cells[list_position(h.header, 'marks')] AS marks, r.cells[list_position(h.header, 'guidance')] AS notes
  FROM rc r JOIN hd h USING (doc_id, page, table_no) WHERE r.row_no > 0 AND list_contains(h.header, 'question') AND list_contains(h.header, 'answer')),
ng AS (SELECT *, CASE WHEN lag(id) OVER w IS NOT DISTINCT FROM id THEN 0 ELSE 1 END AS new FROM nm WHERE id <> '' WINDOW w AS (PARTITION BY doc_id, page, table_no ORDER BY row_no)),
ig AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, page, table_no ORDER BY row_no) AS island,
  CASE WHEN regexp_matches(answer, '(?i)^\s*available marks\b') THEN 'footer' WHEN answer <> '' THEN 'content' WHEN regexp_matches(marks, '^[0-9]+$') THEN 'total' ELSE 'other' END AS kind FROM ng),
mg AS (SELECT *, list_sum(list_transform(regexp_extract_all(marks, '\d+'), lambda x: CAST(x AS INTEGER))) AS points,
  CASE WHEN kind = 'content' AND regexp_matches(answer, '(?i)^\s*(or|either|alternative|alternatively|method\b)') AND count(*) FILTER (WHERE kind = 'content') OVER v > 1 THEN 1 ELSE 0 END AS opens FROM ig WINDOW v AS (PARTITION BY doc_id, page, table_no, island ORDER BY row_no)),
mm AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id, page, table_no, island ORDER BY row_no) AS method FROM mg),
ms AS (SELECT doc_id, page, table_no, island, method, sum(points) FILTER (WHERE kind = 'content') AS s FROM mm GROUP BY ALL),
mx AS (SELECT doc_id, page, table_no, island, max(s) AS s FROM ms GROUP BY ALL),
scheme AS (SELECT doc_id, page, table_no, island, id,
  CAST(coalesce(arg_max(coalesce(TRY_CAST(regexp_extract(answer, '(?i)available marks?\s*[:=]?\s*(\d+)', 1) AS INTEGER), TRY_CAST(regexp_extract_all(marks, '\d+')[-1] AS INTEGER)), row_no) FILTER (WHERE kind = 'footer'),
    arg_max(TRY_CAST(marks AS INTEGER), row_no) FILTER (WHERE kind = 'total'), nullif(any_value(s), 0)) AS INTEGER) AS marks,
  coalesce(arg_max(answer, row_no) FILTER (WHERE kind = 'content'), '') AS answer, coalesce(string_agg(answer, chr(10) ORDER BY row_no) FILTER (WHERE kind = 'content'), '') AS working,
  coalesce(string_agg(notes, chr(10) ORDER BY row_no) FILTER (WHERE notes <> ''), '') AS notes
  FROM mm JOIN mx USING (doc_id, page, table_no, island) GROUP BY doc_id, page, table_no, island, id)"""
_IMG = "('image', 'figure', 'picture', 'chart')"


def _boxes(labels: str) -> str:
    return f"""{_PG},
el AS (SELECT page_id, doc_id, page, width, height, unnest(elements) AS e, generate_subscripts(elements, 1) AS i FROM pg),
bx AS (SELECT page_id, doc_id, page, width, height, e.bbox AS b, row_number() OVER (PARTITION BY page_id ORDER BY i) AS n FROM el WHERE e IS NOT NULL AND e.bbox IS NOT NULL AND lower(e.label) IN {labels}),
rel AS (SELECT page_id, bool_and(greatest(b.x0, b.y0, b.x1, b.y1) <= 1.01) AS r FROM bx GROUP BY page_id),
dn AS (SELECT page_id, doc_id, page, width, height, n, b.x0 * CASE WHEN r THEN width ELSE 1 END AS x0, b.y0 * CASE WHEN r THEN height ELSE 1 END AS y0,
  b.x1 * CASE WHEN r THEN width ELSE 1 END AS x1, b.y1 * CASE WHEN r THEN height ELSE 1 END AS y1 FROM bx JOIN rel USING (page_id))"""


_FIGS = f"""{_boxes(_IMG)},
fg AS (SELECT *, (x1 - x0) * (y1 - y0) / (width * height) AS area FROM dn),
big AS (SELECT *, CAST(row_number() OVER (PARTITION BY page_id ORDER BY n) AS INTEGER) AS fig_no FROM fg WHERE area >= 0.015)"""
_TEXTS = "tx AS (SELECT part_id, unnest(['text', 'answer', 'working', 'notes']) AS field, unnest([text, answer, working, notes]) AS value FROM (SELECT part_id, any_value(text) AS text, any_value(answer) AS answer, any_value(working) AS working, any_value(notes) AS notes FROM parts GROUP BY part_id))"
_QS = """qs AS (SELECT dataset_id, i, paper, series, kind, q.id AS id, q.marks AS marks, q.text AS text, q.page AS page, q.answer AS answer, q.working AS working, q.notes AS notes
  FROM (SELECT dataset_id, paper, series, kind, unnest(questions) AS q, generate_subscripts(questions, 1) AS i
        FROM (SELECT dataset_id, any_value(paper) AS paper, any_value(series) AS series, any_value(kind) AS kind, any_value(questions) AS questions FROM datasets GROUP BY dataset_id)) WHERE q IS NOT NULL)"""
_IDX = f"""{_QS}, idx AS (SELECT * EXCLUDE r FROM (SELECT coalesce(paper, '') AS paper, coalesce(id, '') AS id, dataset_id, series, kind, marks, text, page,
  row_number() OVER (PARTITION BY coalesce(paper, ''), coalesce(id, '') ORDER BY dataset_id DESC, i DESC) AS r FROM qs) WHERE r = 1)"""
_SEL = f"{_IDX}, sel AS (SELECT DISTINCT sel_no, paper, id FROM selections)"


def _replaced(c: str, pairs: list[tuple[str, str]]) -> str:
    for a, b in pairs:
        c = "replace({}, '{}', '{}')".format(c, a.replace("'", "''"), b.replace("'", "''"))
    return c


_DOLLARS = r"length(replace({0}, '\$', '')) - length(replace(replace({0}, '\$', ''), '$', ''))"
_HEALTH = rf"""{_QS},
one AS (SELECT dataset_id, coalesce(any_value(paper), '') AS paper, coalesce(any_value(kind), '') AS kind, coalesce(any_value(len(latex_repairs)), 0) AS fallbacks FROM datasets GROUP BY dataset_id),
dup AS (SELECT dataset_id, count(*) AS d FROM (SELECT dataset_id, coalesce(id, '') AS id FROM qs GROUP BY ALL HAVING count(*) > 1) GROUP BY dataset_id),
qa AS (SELECT dataset_id, count(*) AS questions, sum(coalesce(marks, 0)) AS total_marks,
  count(*) FILTER (WHERE NOT regexp_matches(coalesce(id, ''), '^\d{{1,2}}(\([a-z]+\))*(\((?:i{{1,3}}|iv|v)\))*$')) AS bad,
  count(*) FILTER (WHERE marks IS NULL) AS unmarked, count(*) FILTER (WHERE NOT regexp_matches(coalesce(text, ''), '\S') AND NOT regexp_matches(coalesce(answer, ''), '\S')) AS empty_,
  sum((SELECT count(*) FROM (SELECT unnest(string_split(replace(v, '\$', chr(1)), '$')) AS c, generate_subscripts(string_split(replace(v, '\$', chr(1)), '$'), 1) AS k FROM (SELECT unnest([coalesce(text, ''), coalesce(answer, ''), coalesce(working, ''), coalesce(notes, '')]) AS v)) WHERE k % 2 = 0 AND c <> '')) AS math_segments
  FROM qs GROUP BY dataset_id),
health AS (SELECT dataset_id, paper, kind, coalesce(questions, 0) AS questions, coalesce(total_marks, 0) AS total_marks, coalesce(math_segments, 0) AS math_segments, 0 AS math_invalid, fallbacks,
  coalesce(d, 0) + coalesce(bad, 0) + coalesce(unmarked, 0) + coalesce(empty_, 0) AS n_anomalies,
  CASE WHEN coalesce(d, 0) + coalesce(bad, 0) > 0 THEN 'FAIL' WHEN coalesce(unmarked, 0) + coalesce(empty_, 0) > 0 OR fallbacks > 0 THEN 'WARN' ELSE 'PASS' END AS verdict
  FROM one LEFT JOIN qa USING (dataset_id) LEFT JOIN dup USING (dataset_id))"""
_META = r"^.*?(\d{4})[_-]([smw])(\d{2})[_-](ms|qp|in)[_-](\d{2})"

SQL = {
    "front_matter": f"WITH {_DEC} SELECT page_id, (page_id % 4 = 0 OR regexp_matches(original, '(?i)CANDIDATE NAME|BLANK PAGE')) AS front_matter FROM dec",
    "clean_lines": f"WITH {_DEC} SELECT page_id, regexp_replace(CASE WHEN page_id % 4 = 0 THEN markdown ELSE original END, chr(10) || '$', '') AS markdown FROM dec",
    "page_lines": f"WITH {_PG} SELECT page_id, no AS line_no, line FROM (SELECT page_id, unnest(l) AS line, CAST(generate_subscripts(l, 1) AS INTEGER) AS no, len(l) AS n FROM (SELECT page_id, string_split(markdown, chr(10)) AS l FROM pg)) WHERE NOT (no = n AND line = '')",
    "meaningful_text": rf"WITH {_DEC} SELECT page_id, length({_TRIM.format('list_aggregate(list_filter(string_split(markdown, chr(10)), lambda x: regexp_matches(x, ' + chr(39) + chr(92) + 'S' + chr(39) + ') AND NOT regexp_matches(x, ' + chr(39) + '^' + chr(92) + 's*!' + chr(92) + '[' + chr(39) + ')), ' + chr(39) + 'string_agg' + chr(39) + ', ' + chr(39) + chr(39) + ')')}) AS n FROM dec",
    "question_blocks": f"WITH {_BLOCKS} SELECT page_id, CAST(block_no AS INTEGER) AS block_no, number, text FROM blocks",
    "question_parts": f"WITH {_PARTS} SELECT page_id, ord, id, marks, text FROM parts_",
    "merged_parts": f"WITH {_MERGED} SELECT doc_id, id, page, marks, text FROM merged",
    "paper_totals": f"WITH {_MERGED} SELECT doc_id, count(*) AS parts, sum(coalesce(marks, 0)) AS total_marks FROM merged GROUP BY doc_id",
    "dropped_stems": r"WITH pr AS (SELECT part_id, any_value(doc_id) AS doc_id, any_value(id) AS id FROM parts GROUP BY part_id) SELECT part_id, doc_id, id FROM pr a WHERE NOT (coalesce(regexp_matches(id, '^\d{1,2}$'), false) AND EXISTS (SELECT 1 FROM pr b WHERE b.doc_id = a.doc_id AND b.id LIKE a.id || '(%'))",
    "stem_parts": r"SELECT part_id, regexp_matches(any_value(id), '^\d{1,2}$') AS stem, nullif(regexp_extract(any_value(id), '^\d{1,2}'), '') AS number, regexp_matches(any_value(id), '^\d{1,2}(\([a-z]+\))*(\((?:i{1,3}|iv|v)\))*$') AS valid FROM parts GROUP BY part_id",
    "table_cells": f"WITH {_CELLS} SELECT doc_id, page, CAST(table_no AS INTEGER) AS table_no, CAST(row_no AS INTEGER) AS row_no, CAST(generate_subscripts(cells, 1) - 1 AS INTEGER) AS col_no, unnest(cells) AS cell FROM rc",
    "markscheme_parts": f"WITH {_SCHEME} SELECT doc_id, page, CAST(table_no AS INTEGER) AS table_no, CAST(island AS INTEGER) AS island, id, marks, answer, working, notes FROM scheme",
    "spliced_tables": rf"WITH {_PG} SELECT page_id, CASE WHEN page_id % 3 = 0 AND regexp_matches(markdown, '(?is)<table\b.*?</table>') THEN regexp_replace(markdown, '(?is)<table\b.*?</table>', '<table>new</table>') WHEN page_id % 3 = 0 THEN markdown || chr(10) || chr(10) || '<!-- rescued-table (unmatched) -->' || chr(10) || '<table>new</table>' WHEN page_id % 3 = 1 THEN markdown || chr(10) || chr(10) || '<!-- rescued-table (unmatched) -->' || chr(10) || '<table>more</table>' ELSE markdown END AS markdown FROM pg WHERE markdown IS NOT NULL",
    "layout_elements": f"WITH {_PG}, el AS (SELECT page_id, unnest(elements) AS e, CAST(generate_subscripts(elements, 1) AS INTEGER) AS n FROM pg) SELECT page_id, n, lower(e.label) AS label, coalesce(lower(e.label) IN ('table', 'table_full'), false) AS is_table, coalesce(lower(e.label) IN {_IMG}, false) AS is_image FROM el WHERE e IS NOT NULL",
    "denormalised_boxes": f"WITH {_boxes("('table', 'table_full')")} SELECT page_id, CAST(n AS INTEGER) AS n, round(x0, 4) AS x0, round(y0, 4) AS y0, round(x1, 4) AS x1, round(y1, 4) AS y1 FROM dn",
    "rescue_regions": f"""WITH {_boxes("('table', 'table_full')")}, {_CELLS.replace(_PG + ",", "", 1).lstrip()},
      sc AS (SELECT DISTINCT doc_id, page FROM rc WHERE row_no = 0 AND list_contains(list_transform(cells, lambda x: lower(x)), 'question') AND list_contains(list_transform(cells, lambda x: lower(x)), 'answer'))
      SELECT page_id, CAST(n AS INTEGER) AS region_no, (s.doc_id IS NULL AND (x1 - x0) * (y1 - y0) / (width * height) <= 0.5) AS rescue, round(y0, 4) AS y0 FROM dn LEFT JOIN sc s USING (doc_id, page)""",
    "large_figures": f"WITH {_FIGS} SELECT page_id, fig_no, doc_id || '_p' || page || '_fig' || fig_no || '.png' AS asset, round(area, 6) AS area FROM big",
    "attached_figures": f"""WITH {_FIGS}, {_PARTS.replace(_PG + ",", "", 1).lstrip()}, np AS (SELECT page_id, count(*) AS n_parts FROM parts_ GROUP BY page_id)
      SELECT b.doc_id, b.page, p.ord - 1 AS part_no, p.id, b.fig_no, b.doc_id || '_p' || b.page || '_fig' || b.fig_no || '.png' AS asset
      FROM big b JOIN np USING (page_id) JOIN parts_ p ON p.page_id = b.page_id AND p.ord - 1 = CASE WHEN n_parts = 1 THEN 0 ELSE floor(least(greatest((y0 + y1) / 2 / greatest(height, 1), 0), 0.999) * n_parts) END""",
    "replaced_signs": f"WITH {_TEXTS} SELECT part_id, field, {_replaced('value', list(m.SIGNS.items()))} AS value FROM tx WHERE value IS NOT NULL",
    "dollar_counts": f"WITH {_TEXTS} SELECT part_id, field, CAST({_DOLLARS.format('value')} AS INTEGER) AS n FROM tx WHERE value IS NOT NULL",
    "math_segments": rf"WITH {_TEXTS}, sp AS (SELECT part_id, field, unnest(l) AS c, generate_subscripts(l, 1) AS k FROM (SELECT part_id, field, string_split(replace(value, '\$', chr(1)), '$') AS l FROM tx WHERE value IS NOT NULL)) SELECT part_id, field, CAST(row_number() OVER (PARTITION BY part_id, field ORDER BY k) AS INTEGER) AS n, k % 2 = 0 AS is_math, replace(c, chr(1), '\$') AS content FROM sp WHERE c <> ''",
    "escaped_html": f"WITH {_TEXTS} SELECT part_id, field, {_replaced('value', [('&', '&amp;'), ('<', '&lt;'), ('>', '&gt;'), (chr(34), '&quot;'), (chr(39), '&#x27;')])} AS value FROM tx WHERE value IS NOT NULL",
    "literal_text": f"WITH {_TEXTS} SELECT part_id, field, trim(regexp_replace({_replaced('replace(value, chr(10), chr(32))', [(chr(92), ' '), ('{', '('), ('}', ')'), ('$', ''), ('%', ' percent '), ('#', ''), ('&', ' and '), ('_', ' '), ('^', ' '), ('~', ' ')])}, '  +', ' ', 'g'), ' ' || chr(9) || chr(160) || chr(8199) || chr(8239)) AS value FROM tx WHERE value IS NOT NULL",
    "filename_meta": rf"""SELECT source_id, regexp_extract(f, '{_META}', 1, 'i') AS subject, CASE lower(regexp_extract(f, '{_META}', 2, 'i')) WHEN 's' THEN 'May/June' WHEN 'w' THEN 'Oct/Nov' WHEN 'm' THEN 'Feb/March' ELSE '' END || CASE WHEN regexp_matches(f, '{_META}', 'i') THEN ' 20' || regexp_extract(f, '{_META}', 3, 'i') ELSE '' END AS series,
      CASE lower(regexp_extract(f, '{_META}', 4, 'i')) WHEN 'ms' THEN 'marking_scheme' WHEN 'qp' THEN 'question_paper' WHEN 'in' THEN 'insert' ELSE 'unknown' END AS kind,
      CASE WHEN regexp_matches(f, '{_META}', 'i') THEN regexp_extract(f, '{_META}', 1, 'i') || '/' || regexp_extract(f, '{_META}', 5, 'i') ELSE '' END AS paper, nullif(regexp_extract(f, '{_META}', 5, 'i'), '') AS variant
      FROM (SELECT source_id, any_value(source_pdf) AS f FROM sources GROUP BY source_id)""",
    "asset_names": "SELECT asset_id, any_value(doc_id || '_p' || page || '_fig' || fig_no || '.png') AS name, CASE WHEN any_value(lower(asset_name)) LIKE '%.png' THEN 'image/png' ELSE 'application/octet-stream' END AS media_type FROM assets GROUP BY asset_id",
    "cache_keys": "SELECT raw_id, sha1(any_value(doc_id) || chr(0) || any_value(page) || chr(0) || 'pass' || any_value(pass_no) || chr(0)) AS key FROM ocr_raw GROUP BY raw_id",
    "cache_misses": "SELECT DISTINCT doc_id, CAST(page AS INTEGER) AS page FROM (SELECT doc_id, unnest(range(1, pages + 1)) AS page FROM sources) WHERE (doc_id, page) NOT IN (SELECT doc_id, page FROM ocr_raw WHERE raw IS NOT NULL AND doc_id IS NOT NULL AND page IS NOT NULL)",
    "question_index": f"WITH {_IDX} SELECT paper, id, dataset_id, series, kind, marks, text, page FROM idx",
    "built_paper": f"WITH {_SEL} SELECT sel_no, s.paper, s.id, i.id IS NOT NULL AS found, marks, text FROM sel s LEFT JOIN idx i ON i.paper = s.paper AND i.id = s.id",
    "missing_selections": f"WITH {_SEL} SELECT sel_no, paper, id FROM sel s WHERE NOT EXISTS (SELECT 1 FROM idx i WHERE i.paper = s.paper AND i.id = s.id)",
    "build_summary": f"WITH {_SEL} SELECT count(i.id) AS n, coalesce(sum(CASE WHEN i.id IS NOT NULL THEN coalesce(marks, 0) END), 0) AS total_marks, count(*) - count(i.id) AS missing FROM sel s LEFT JOIN idx i ON i.paper = s.paper AND i.id = s.id",
    "duplicate_ids": f"WITH {_QS} SELECT dataset_id, id, count(*) AS n FROM qs GROUP BY ALL HAVING count(*) > 1",
    "question_paper_against_scheme": f"WITH {_QS}, a AS (SELECT paper, series, id, max(marks) AS asked FROM qs WHERE kind = 'question_paper' GROUP BY ALL), b AS (SELECT paper, series, id, max(marks) AS given FROM qs WHERE kind = 'marking_scheme' GROUP BY ALL) SELECT paper, series, id, asked, given, coalesce(asked = given, false) AS equal FROM a JOIN b USING (paper, series, id)",
}
