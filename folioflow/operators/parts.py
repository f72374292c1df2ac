"""Question parts of documents: text layer, rescued tables, carry, segmentation, marks, stems, merge, figures, datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions import geometry as g
from folioflow.functions import math as m
from folioflow.functions import text as t
from folioflow.operators import marks, tables, validate
from folioflow.session import cut_lineage

#: Order of a part in its document: mark schemes of a page first, by table and island, then its prose.
ORDER = "struct<page: int, prose: int, table_no: int, n: int>"
_PAGE = ["doc_id", "page"]


def order(page: Column, prose: int, table_no: Column, n: Column) -> Column:
    return F.struct(page.alias("page"), F.lit(prose).alias("prose"), table_no.cast("int").alias("table_no"), n.cast("int").alias("n"))


def distinct_pages(pages: DataFrame) -> DataFrame:
    """Each page once; repeated rows are exact copies. The rows of a document come to lie together, so its page windows need no further shuffle."""
    return pages.repartition("doc_id").dropDuplicates(["doc_id", "page_id"])


# -- the text of a page -------------------------------------------------------


def with_text_layer(pages: DataFrame, words: DataFrame) -> DataFrame:
    """pages with what the text layer knows: lost question numbers put back, and pages of next to no content rebuilt."""
    numbers = marks.question_numbers(words).groupBy(*_PAGE).agg(F.array_sort(F.collect_list(F.struct("y", F.col("number").alias("n")))).alias("numbers_"))
    rows = pages.join(numbers, _PAGE, "left").join(marks.rebuilt_text(words).withColumnRenamed("text", "rebuilt_"), _PAGE, "left")
    text = F.coalesce("markdown", F.lit(""))
    none = F.array().cast("array<struct<y:double,n:int>>")
    rows = rows.withColumn("markdown", t.inject_number(text, F.coalesce("numbers_", none)))
    return rows.withColumn("markdown", t.sparse_fallback(F.col("markdown"), F.coalesce("rebuilt_", F.lit("")))).drop("numbers_", "rebuilt_")


def with_rescued(pages: DataFrame, rescued: DataFrame) -> DataFrame:
    """pages with the second reading of their table regions spliced in. rescued: (doc_id, page, region_no, markdown); regions without a row keep their first reading."""
    entry = F.struct("region_no", F.coalesce("markdown", F.lit("")).alias("markdown"))
    by_page = rescued.groupBy(*_PAGE).agg(F.map_from_entries(F.collect_list(entry)).alias("of"), F.max("region_no").alias("last"))
    regions = by_page.select(*_PAGE, F.transform(F.sequence(F.lit(1), F.col("last").cast("int")), lambda i: F.coalesce(F.try_element_at(F.col("of"), i), F.lit(""))).alias("rescued_"))
    spliced = tables.splice(F.coalesce("markdown", F.lit("")), F.coalesce("rescued_", F.array().cast("array<string>")))
    return pages.join(regions, _PAGE, "left").withColumn("markdown", spliced).drop("rescued_")


# -- segmentation -----------------------------------------------------------------


def _last_number(ids: Column) -> Column:
    numbers = F.filter(F.transform(ids, t.question_number), lambda n: n.isNotNull())
    return F.try_element_at(numbers, F.lit(-1))


def _carrying(pages: DataFrame) -> DataFrame:
    """pages with `grids` of their tables, `prose` without mark schemes and `carried`, the number that flows in.

    Closed form of the page-to-page state: a page sets it by the last number
    among its parts, or, unnumbered with prose and only while nothing is
    carried yet, by its tables'. The window reads the numbers alone.
    """
    rows = tables.with_grids(pages.withColumn("markdown", t.lstrip(F.coalesce("markdown", F.lit("")))))
    text = F.col("markdown")
    rows = rows.withColumn("prose", tables.without_schemes(text, F.col("grids")))
    prose = F.col("prose")
    schemes = F.filter("grids", tables.is_scheme_grid)
    rows = rows.withColumn("prose_last", _last_number(F.transform(t.prose_parts(prose), lambda x: x["id"])))
    rows = rows.withColumn("table_last", F.when(F.size(schemes) > 0, _last_number(F.flatten(F.transform(schemes, tables.scheme_ids)))))
    front = t.is_front_matter(text)
    own = t.starts_numbered(text) | t.starts_numbered(prose) | t.blank(prose)
    before = Window.partitionBy("doc_id").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    a, b = F.when(~front & own, F.coalesce("prose_last", "table_last")), F.when(~front & ~own, F.col("table_last"))
    rows = rows.withColumn("a", a).withColumn("b", b)
    return rows.withColumn("carried", F.coalesce(F.last("a", True).over(before), F.first("b", True).over(before)))


def carried_numbers(pages: DataFrame) -> DataFrame:
    """(doc_id, page, carried): the question number that flows into each page. pages: (doc_id, page, markdown)."""
    return _carrying(pages.select("doc_id", "page", "markdown")).select("doc_id", "page", "carried")


def segmented(pages: DataFrame) -> DataFrame:
    """(doc_id, page, schemes, prose) of the pages that aren't front matter.

    schemes: array<struct<table_no, grid>> of the mark schemes; prose: the parts
    of the rest, of a continuation page under the number it continues.
    """
    rows = _carrying(pages.select("doc_id", "page", "markdown"))
    needs = F.col("carried").isNotNull() & ~t.blank(F.col("markdown")) & ~t.starts_numbered(F.col("markdown"))
    prose = t.prose_parts(F.when(needs, F.concat_ws(" ", "carried", "prose")).otherwise(F.col("prose")))
    numbered = F.transform("grids", lambda x, i: F.struct(i.alias("table_no"), x.alias("grid")))
    whole = rows.filter(~t.is_front_matter(F.col("markdown")))
    return whole.select("doc_id", "page", F.filter(numbered, lambda x: tables.is_scheme_grid(x["grid"])).alias("schemes"), prose.alias("prose"))


def page_parts(rows: DataFrame) -> DataFrame:
    """(doc_id, page, ord, id, marks, text, answer, working, notes) out of segmented pages: mark schemes first, then prose."""
    grids = rows.filter(F.size("schemes") > 0).select("doc_id", "page", F.explode("schemes").alias("s")).select("doc_id", "page", "s.table_no", "s.grid")
    scheme = tables.scheme_parts(tables.grid_rows(grids))
    scheme = scheme.select("doc_id", "page", order(F.col("page"), 0, F.col("table_no"), F.col("island")).alias("ord"), "id", "marks", "text", "answer", "working", "notes")
    prose = rows.select("doc_id", "page", F.posexplode("prose").alias("i", "p"))
    blank = [F.lit("").alias(c) for c in ("answer", "working", "notes")]
    prose = prose.select("doc_id", "page", order(F.col("page"), 1, F.lit(0), F.col("i")).alias("ord"), "p.id", "p.marks", "p.text", *blank)
    return scheme.unionByName(prose)


def document_parts(pages: DataFrame) -> DataFrame:
    """Parts of whole documents: junk lines dropped, continuation pages under the number they continue."""
    clean = distinct_pages(pages).select("doc_id", "page", t.clean_junk(F.coalesce("markdown", F.lit(""))).alias("markdown"))
    return page_parts(cut_lineage(segmented(clean)))  # read twice below


def drop_stems(parts: DataFrame) -> DataFrame:
    """Without bare stems whose question has lettered parts in the same document."""
    lettered = parts.filter(F.contains("id", F.lit("("))).select("doc_id", F.substring_index("id", "(", 1).alias("id")).distinct()
    keep = parts.filter(~t.is_stem(F.col("id")) | F.col("id").isNull())
    stems = parts.filter(t.is_stem(F.col("id"))).join(lettered, ["doc_id", "id"], "left_anti")
    return keep.unionByName(stems.select(keep.columns))


def merge_parts(parts: DataFrame, figures: bool = False) -> DataFrame:
    """One row per (doc_id, id) in order of first appearance.

    text is the longest that isn't blank, the first on a tie, or the workings;
    answer the last that isn't empty; working and notes line by line; marks
    the last `available marks N` in answer, text or notes, else the largest.
    A part that stands alone passes unchanged.
    """
    total = lambda c: F.nullif(F.regexp_extract(c, r"(?i)available marks\s*[:=]?\s*(\d+)", 1), F.lit(""))
    own_total = F.coalesce(total(F.col("notes")), total(F.col("text")), total(F.col("answer"))).try_cast("int")
    in_order = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(c) != "", F.struct("ord", F.col(c).alias("v"))))), lambda x: x["v"]), "\n")
    rest = [F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("ord", F.col("diagrams").alias("v")))), lambda x: x["v"])).alias("diagrams")] if figures else []
    agg = parts.withColumn("own_total", own_total).groupBy("doc_id", "id").agg(
        F.count("*").alias("n"),
        F.min("ord").alias("ord"),
        F.min_by("page", "ord").alias("page"),
        F.max("marks").alias("most"),
        F.max_by("own_total", F.when(F.col("own_total").isNotNull(), F.col("ord"))).alias("total"),
        F.min_by("text", F.when(~t.blank(F.col("text")), F.struct(-F.length("text"), F.col("ord")))).alias("longest"),
        F.min_by("text", "ord").alias("only"),
        F.max_by("answer", F.when(F.col("answer") != "", F.col("ord"))).alias("answer"),
        in_order("working").alias("working"),
        in_order("notes").alias("notes"),
        *rest,
    )
    alone = F.col("n") == 1
    return agg.select(
        "doc_id", "id", "ord", "page",
        F.when(alone, F.col("most")).otherwise(F.coalesce("total", "most")).alias("marks"),
        F.when(alone, F.col("only")).otherwise(F.coalesce("longest", "working")).alias("text"),
        F.coalesce("answer", F.lit("")).alias("answer"), "working", "notes", *(["diagrams"] if figures else []),
    )


def attach_figures(parts: DataFrame, pages: DataFrame, least: float = g.MIN_FIGURE_AREA) -> DataFrame:
    """(doc_id, page, part_no, ord, id, fig_no, asset): figures by their middle on the page's n parts, from top to bottom."""
    place = Window.partitionBy("doc_id", "page").orderBy("ord")
    numbered = parts.select("doc_id", "page", "ord", "id", (F.row_number().over(place) - 1).alias("part_no"))
    n = parts.groupBy("doc_id", "page").agg(F.count("*").alias("n"))
    found = pages.select("doc_id", "page", "height", F.posexplode(g.large_figures(F.col("elements"), F.col("width"), F.col("height"), least)).alias("i", "box"))
    at = F.when(F.col("n") == 1, 0).otherwise(g.part_index(F.col("box"), F.col("height"), F.col("n")))
    placed = found.join(n, ["doc_id", "page"]).select("doc_id", "page", (F.col("i") + 1).alias("fig_no"), "box", at.alias("part_no"))
    rows = placed.join(numbered, ["doc_id", "page", "part_no"])
    return rows.select("doc_id", "page", "part_no", "ord", "id", "fig_no", t.asset_name(F.col("doc_id"), F.col("page"), F.col("fig_no")).alias("asset"), F.col("box.y0").alias("y0"))


def assembled_parts(pages: DataFrame, words: DataFrame | None = None, rescued: DataFrame | None = None, least_figure: float = g.MIN_FIGURE_AREA) -> DataFrame:
    """Merged parts with their figures, from pages each once.

    In order: text layer, rescued tables, junk lines, carry, segmentation,
    marks by position, marks of pages without numbers, figures, stems, merge.
    words and rescued are optional: scanned pages have no text layer.
    """
    text = pages if words is None else with_text_layer(pages, words)
    text = text if rescued is None else with_rescued(text, rescued)
    clean = text.select("doc_id", "page", t.clean_junk(F.coalesce("markdown", F.lit(""))).alias("markdown"))
    parts = page_parts(cut_lineage(segmented(clean)))
    if words is not None:
        parts = marks.fill_orphans(marks.fill_marks(parts, marks.band_marks(words)), marks.orphan_marks(words))
    parts = cut_lineage(parts)  # read by figures, stems and merge
    figures = attach_figures(parts, pages, least_figure).groupBy("doc_id", "page", "ord").agg(F.transform(F.array_sort(F.collect_list(F.struct("y0", "fig_no", "asset"))), lambda x: x["asset"]).alias("diagrams"))
    parts = parts.join(figures, ["doc_id", "page", "ord"], "left").withColumn("diagrams", F.coalesce("diagrams", F.array().cast("array<string>")))
    return merge_parts(drop_stems(parts), figures=True)


def datasets(pages: DataFrame, words: DataFrame | None = None, rescued: DataFrame | None = None, sanitize: bool = True, valid=m.is_valid, command: list[str] | None = None, least_figure: float = g.MIN_FIGURE_AREA) -> DataFrame:
    """One nested dataset per document, as the reader and the JSON sink have it.

    Answer fields are null unless it is a marking scheme. With sanitize, the
    math of the texts is repaired and latex_repairs lists what became literal
    text, by `valid` or by the renderer that `command` runs.
    """
    pages = distinct_pages(pages)
    merged = assembled_parts(pages, words, rescued, least_figure)
    meta = t.parse_filename(F.col("doc_id"))
    scheme = meta["kind"] == "marking_scheme"
    only = lambda c: F.when(scheme, F.col(c)).alias(c)
    q = F.struct("ord", "id", "marks", "text", "diagrams", "page", only("answer"), only("working"), only("notes"))
    by_doc = merged.groupBy("doc_id").agg(F.array_sort(F.collect_list(q)).alias("qs"))
    n_pages = pages.groupBy("doc_id").agg(F.count("*").cast("int").alias("pages"))
    questions = F.coalesce(F.transform("qs", lambda x: F.struct(*[x[c].alias(c) for c in ("id", "marks", "text", "diagrams", "page", "answer", "working", "notes")])), F.array().cast("array<struct<id:string,marks:int,text:string,diagrams:array<string>,page:int,answer:string,working:string,notes:string>>"))
    rows = n_pages.join(by_doc, "doc_id", "left")
    out = rows.select("doc_id", meta["paper"].alias("paper"), meta["subject"].alias("subject"), meta["series"].alias("series"), meta["kind"].alias("kind"), F.concat("doc_id", F.lit(".pdf")).alias("source_pdf"), "pages", questions.alias("questions"))
    none = F.array().cast("array<string>")
    if not sanitize:
        return out.withColumn("latex_repairs", none)
    out = cut_lineage(out)
    fixed = validate.sanitized_datasets(out, "doc_id", valid, command)
    return out.withColumnRenamed("questions", "raw_").join(fixed, "doc_id", "left").withColumn("questions", F.coalesce("questions", "raw_")).withColumn("latex_repairs", F.coalesce("latex_repairs", none)).select(*out.columns, "latex_repairs")
