"""Assembled datasets: question index, custom papers, health reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions import math as m
from folioflow.functions import text as t

#: Fixed value: the grammar of question ids.
QUESTION_ID = r"^\d{1,2}(\([a-z]+\))*(\((?:i{1,3}|iv|v)\))*$"
FIELDS = ("text", "answer", "working", "notes")
#: Selection numbers counted by one task.
STRETCH = 10_000


def questions(datasets: DataFrame, order: str = "dataset_id") -> DataFrame:
    """(order, ord, paper, series, kind, id, marks, text, diagrams, ...) of the questions there are; repeated dataset rows once."""
    one = datasets.dropDuplicates([order])
    rows = one.select(order, "paper", "series", "kind", F.posexplode("questions").alias("ord", "q")).filter("q is not null")
    return rows.select(order, "ord", "paper", "series", "kind", "q.*")


def question_index(datasets: DataFrame, order: str = "dataset_id") -> DataFrame:
    """The last question of each (paper, id), later datasets winning. Series and kind are not part of the key.

    An aggregate with map-side combine: only the winner of each key is shuffled.
    """
    q = questions(datasets, order).withColumn("paper", F.coalesce("paper", F.lit(""))).withColumn("id", F.coalesce("id", F.lit("")))
    rest = [c for c in q.columns if c not in ("paper", "id")]
    last = q.groupBy("paper", "id").agg(F.max_by(F.struct(*rest), F.struct(order, "ord")).alias("q"))
    return last.select("paper", "id", "q.*")


def select_questions(selections: DataFrame, index: DataFrame) -> DataFrame:
    """Selections in their order with the question found, if any; `found` tells. Repeated selection rows count once."""
    s = selections.select("sel_no", F.col("paper").alias("paper"), "id").distinct()
    return s.join(index.withColumn("found", F.lit(True)), ["paper", "id"], "left").withColumn("found", F.coalesce("found", F.lit(False)))


def missing_selections(selections: DataFrame, index: DataFrame) -> DataFrame:
    return selections.select("sel_no", "paper", "id").distinct().join(index.select("paper", "id"), ["paper", "id"], "left_anti")


def build_summary(selected: DataFrame) -> DataFrame:
    """One row: how many questions were found, their marks (null counts 0), how many are missing."""
    return selected.agg(F.count_if("found").alias("n"), F.coalesce(F.sum(F.when(F.col("found"), F.coalesce("marks", F.lit(0)))), F.lit(0)).alias("total_marks"), F.count_if(~F.col("found")).alias("missing"))


# -- health -------------------------------------------------------------------


def anomalies(datasets: DataFrame, order: str = "dataset_id") -> DataFrame:
    """(dataset_id, place, anomaly): duplicate ids first, then by question suspicious id, missing marks, empty content."""
    q = questions(datasets, order).withColumn("id", F.coalesce("id", F.lit("")))
    twice = q.groupBy(order, "id").agg(F.count("*").alias("n"), F.min("ord").alias("ord")).filter("n > 1")
    dup = twice.select(order, F.struct(F.lit(0).alias("k"), "ord", F.lit(0).alias("i")).alias("place"), F.format_string("duplicate id: %s (x%d)", "id", "n").alias("anomaly"))
    tests = F.array(
        F.when(~F.col("id").rlike(QUESTION_ID), F.concat(F.lit("suspicious id: '"), F.col("id"), F.lit("'"))),
        F.when(F.col("marks").isNull(), F.concat(F.lit("missing marks: "), F.col("id"))),
        F.when(t.blank(F.col("text")) & t.blank(F.col("answer")), F.concat(F.lit("empty content: "), F.col("id"))),
    )
    own = q.select(order, "ord", F.posexplode(tests).alias("i", "anomaly")).filter("anomaly is not null")
    return dup.unionByName(own.select(order, F.struct(F.lit(1).alias("k"), "ord", "i").alias("place"), "anomaly"))


def math_counts(datasets: DataFrame, order: str = "dataset_id", valid=m.is_valid) -> DataFrame:
    """(dataset_id, segments, invalid) over the four text fields."""
    each = F.flatten(F.array(*[m.math_segments(F.coalesce(F.col(f), F.lit(""))) for f in FIELDS]))
    segs = questions(datasets, order).select(order, each.alias("s"))
    return segs.groupBy(order).agg(F.sum(F.size("s")).alias("segments"), F.sum(F.size(F.filter("s", lambda x: ~valid(x)))).alias("invalid"))


def health(datasets: DataFrame, order: str = "dataset_id", valid=m.is_valid, counts: DataFrame | None = None) -> DataFrame:
    """One report per dataset with its verdict: FAIL, WARN or PASS.

    counts: (dataset_id, segments, invalid, validated) by a renderer; without it math is judged by `valid` and counts as not validated.
    """
    counts = math_counts(datasets, order, valid).withColumn("validated", F.lit(False)) if counts is None else counts
    one = datasets.dropDuplicates([order])
    real = F.filter("questions", lambda q: q.isNotNull())
    base = one.select(
        order, F.coalesce("paper", F.lit("")).alias("paper"), F.coalesce("kind", F.lit("")).alias("kind"), F.greatest(F.coalesce(F.size(real), F.lit(0)), F.lit(0)).alias("questions"),
        F.coalesce(F.aggregate(real, F.lit(0).cast("bigint"), lambda a, q: a + F.coalesce(q["marks"], F.lit(0))), F.lit(0)).alias("total_marks"),
        F.greatest(F.coalesce(F.size("latex_repairs"), F.lit(0)), F.lit(0)).alias("fallbacks"),
    )
    found = anomalies(datasets, order).groupBy(order).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "anomaly"))), lambda x: x["anomaly"]).alias("anomalies"))
    rep = base.join(found, order, "left").join(counts, order, "left")
    rep = rep.withColumn("anomalies", F.coalesce("anomalies", F.array().cast("array<string>"))).fillna(0, ["segments", "invalid"]).fillna(False, ["validated"])
    broken = F.exists("anomalies", lambda a: a.contains("suspicious id") | a.contains("duplicate"))
    verdict = F.when((F.col("invalid") > 0) | broken, "FAIL").when((F.size("anomalies") > 0) | (F.col("fallbacks") > 0), "WARN").otherwise("PASS")
    return rep.select(order, "paper", "kind", "questions", "total_marks", F.col("segments").alias("math_segments"), F.col("invalid").alias("math_invalid"), "validated", "fallbacks", "anomalies", verdict.alias("verdict"))


def report_text(most: int = 12) -> Column:
    """A report as text: a headline, the first anomalies, how many more there are. Only what a renderer has judged is called valid."""
    math = F.when(F.col("validated"), F.format_string("KaTeX %d/%d valid", F.col("math_segments") - F.col("math_invalid"), "math_segments")).otherwise(
        F.format_string("math not validated (%d/%d with balanced braces)", F.col("math_segments") - F.col("math_invalid"), "math_segments")
    )
    head = F.format_string("[%s] %s (%s): %d questions, %d marks, %s, %d fallbacks", "verdict", "paper", "kind", "questions", "total_marks", math, "fallbacks")
    shown = F.transform(F.slice("anomalies", 1, most), lambda a: F.concat(F.lit("    ! "), a))
    more = F.when(F.size("anomalies") > most, F.array(F.format_string("    ... +%d more", F.size("anomalies") - most))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(F.array(head), shown, more), "\n")


# -- texts ----------------------------------------------------------------------


def dataset_markdown() -> Column:
    """A dataset row as Markdown. Missing marks print as None; working, answer and guidance before plain text."""
    s = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    qs = F.coalesce(F.filter("questions", lambda q: q.isNotNull()), F.expr("array()"))
    total = F.aggregate(qs, F.lit(0), lambda a, q: a + F.coalesce(q["marks"], F.lit(0)))
    head = F.array(
        F.concat(F.lit("# "), s(F.col("paper")), F.lit(" — "), s(F.col("kind"))), F.lit(""), F.concat(F.lit("- source_pdf: `"), s(F.col("source_pdf")), F.lit("`")),
        F.concat(F.lit("- series: "), s(F.col("series"))), F.concat(F.lit("- pages: "), s(F.col("pages"))), F.concat(F.lit("- questions: "), F.size(qs).cast("string")),
        F.concat(F.lit("- total_marks: "), total.cast("string")), F.lit(""), F.lit("---"), F.lit(""),
    )
    none = F.array().cast("array<string>")

    def question(q: Column) -> Column:
        has = lambda c: F.coalesce(q[c], F.lit("")) != ""
        return F.concat(
            F.array(F.concat(F.lit("## "), s(q["id"]), F.lit("  ("), F.coalesce(q["marks"].cast("string"), F.lit("None")), F.lit(" marks)")), F.lit("")),
            F.when(has("working"), F.array(F.lit("**Working:**"), F.lit(""), q["working"], F.lit(""))).otherwise(none),
            F.when(has("answer") & ~q["answer"].eqNullSafe(q["working"]), F.array(F.concat(F.lit("**Answer:** "), q["answer"]), F.lit(""))).otherwise(none),
            F.when(has("notes"), F.array(F.concat(F.lit("**Guidance:** "), q["notes"]), F.lit(""))).otherwise(none),
            F.when(~has("working") & ~has("answer"), F.array(s(q["text"]), F.lit(""))).otherwise(none),
            F.coalesce(F.flatten(F.transform(F.filter(q["diagrams"], lambda d: d.isNotNull()), lambda d: F.array(F.concat(F.lit("![diagram]("), d, F.lit(")")), F.lit("")))), none),
        )

    return F.array_join(F.concat(head, F.flatten(F.transform(qs, question))), "\n")


def _numbered(selected: DataFrame) -> DataFrame:
    """The questions found with `no`, their number in selection order, and m, their marks.

    Counted in two levels: within stretches of STRETCH selection numbers, and over the stretches' sizes, of which there are few.
    """
    found = selected.filter("found").withColumn("m", F.coalesce("marks", F.lit(0))).withColumn("stretch", F.floor(F.col("sel_no") / STRETCH))
    sizes = found.groupBy("stretch").agg(F.count("*").alias("n_"))
    ahead = sizes.withColumn("ahead", F.coalesce(F.sum("n_").over(Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n_")
    inside = F.row_number().over(Window.partitionBy("stretch").orderBy("sel_no", "paper", "id"))
    return found.withColumn("inside", inside).join(ahead, "stretch").withColumn("no", (F.col("ahead") + F.col("inside")).cast("int")).drop("ahead", "inside", "stretch")


def _paper(cards: DataFrame) -> DataFrame:
    """(cards, total): the one text of a custom paper holds all its cards, so they come together in one row."""
    one = cards.agg(F.array_sort(F.collect_list(F.struct("no", "card"))).alias("c"), F.sum("m").alias("t"))
    return one.select(F.coalesce(F.transform("c", lambda x: x["card"]), F.array().cast("array<string>")).alias("cards"), F.coalesce("t", F.lit(0)).alias("total"))


def markdown_cards(selected: DataFrame) -> DataFrame:
    """(no, sel_no, m, card): the text of each question of a custom paper."""
    figs = F.array_join(F.transform(F.coalesce("diagrams", F.expr("array()")), lambda d: F.concat(F.lit("\n\n![diagram]("), d, F.lit(")"))), "")
    card = F.concat(F.format_string("## %d. (%s %s)  [%d marks]\n\n", "no", "paper", "id", "m"), F.coalesce("text", F.lit("")), figs, F.lit("\n"))
    return _numbered(selected).select("no", "sel_no", "m", card.alias("card"))


def paper_markdown(selected: DataFrame, title: str = "Custom Paper") -> DataFrame:
    return _paper(markdown_cards(selected)).select(F.concat_ws("\n", F.lit(f"# {title}\n"), F.array_join("cards", "\n"), F.format_string("---\n**Total: %d marks**", "total")).alias("markdown"))


def _file_name(path: str) -> Column:
    return F.regexp_extract(path, r"[^/\\]*$", 0)


def html_cards(selected: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """(no, sel_no, m, card): each question of a custom paper as HTML. images: (path, content), matched by file name; a figure without an image is left out."""
    e = t.html_escape
    if images is not None:
        pairs = selected.select("sel_no", F.posexplode("diagrams").alias("i", "path")).select("sel_no", "i", _file_name("path").alias("name"))
        pairs = pairs.join(images.select(_file_name("path").alias("name"), "content"), "name").select("sel_no", "i", t.data_url(F.col("content")).alias("url"))
        by_sel = pairs.groupBy("sel_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "url"))), lambda x: x["url"]).alias("urls"))
        selected = selected.join(by_sel, "sel_no", "left")
    else:
        selected = selected.withColumn("urls", F.array().cast("array<string>"))
    figs = F.coalesce(F.array_join(F.transform("urls", lambda u: F.concat(F.lit('<img src="'), u, F.lit('" alt="diagram"/>'))), ""), F.lit(""))
    card = F.concat(
        F.format_string('<div class="q"><div class="qh"><span>Q%d &middot; %s %s</span><span class="mk">[%d marks]</span></div><div class="qb">', F.col("no"), e(F.col("paper")), e(F.col("id")), F.col("m")),
        e(F.coalesce("text", F.lit(""))), F.lit("</div>"), figs, F.lit("</div>"),
    )
    return _numbered(selected).select("no", "sel_no", "m", card.alias("card"))


def paper_html(selected: DataFrame, title: str = "Custom Paper", images: DataFrame | None = None) -> DataFrame:
    """The paper as a page of HTML."""
    page = _paper(html_cards(selected, images))
    head = F.concat(F.lit('<!doctype html>\n<html><head><meta charset="utf-8"><title>'), t.html_escape(F.lit(title)), F.lit("</title></head>\n<body><h1>"), t.html_escape(F.lit(title)), F.lit("</h1>"))
    return page.select(F.concat(head, F.array_join("cards", ""), F.format_string("\n<p><strong>Total: %d marks</strong></p>\n</body></html>", "total")).alias("html"))
