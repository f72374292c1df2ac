"""Queries on positioned words and rendered tables.

The words and tables are rendered from orders and line items and read back by
the operators; the SQL computes the same rows from the source tables alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.operators import marks, tables
from folioflow.session import table


def _orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders as questions: numbered within their customer, who is the document, on three pages."""
    o = table(spark, d, "orders")
    no = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    return o.select(F.concat(F.lit("c"), F.col("o_custkey")).alias("doc_id"), (F.pmod("o_orderkey", F.lit(3)) + 1).cast("int").alias("page"), "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", no.alias("no"))


def _word(rows: DataFrame, x, y, height, word) -> DataFrame:
    return rows.select(
        "doc_id", "page", F.lit(595.0).alias("width"), F.lit(2000.0).alias("height"), x.cast("double").alias("x0"), y.cast("double").alias("y0"),
        (x + 10).cast("double").alias("x1"), (y + height).cast("double").alias("y1"), word.alias("word"),
    )


def words(spark: SparkSession, d: str) -> DataFrame:
    """A number per order, a mark per line item, and words that are neither: above the first number, too small, too far right."""
    o = _orders(spark, d)
    li = table(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    y = F.col("no") * 40
    numbers = _word(o, F.lit(30), y, F.lit(9), F.col("no").cast("string"))
    mark = _word(li, F.lit(400) + F.col("l_quantity"), y + F.col("l_linenumber") * 3, F.lit(9), F.format_string("[%d]", F.col("l_quantity").cast("int")))
    above = _word(o.filter("no = 1"), F.lit(400), F.lit(5), F.lit(9), F.lit("[9]"))
    small = _word(o, F.lit(30), y + 20, F.lit(4), F.lit("88"))
    right = _word(o, F.lit(300), y + 20, F.lit(9), F.lit("77"))
    return numbers.unionByName(mark).unionByName(above).unionByName(small).unionByName(right)


def question_number_words(spark: SparkSession, d: str) -> DataFrame:
    return marks.question_numbers(words(spark, d)).select("doc_id", "page", "number", "y")


def band_marks(spark: SparkSession, d: str) -> DataFrame:
    return marks.band_marks(words(spark, d)).select("doc_id", "page", "number", "mark", "y", "x")


def question_marks(spark: SparkSession, d: str) -> DataFrame:
    """Marks of each question in reading order, as one list."""
    rows = marks.band_marks(words(spark, d)).groupBy("doc_id", "page", "number").agg(F.array_sort(F.collect_list(F.struct("y", "x", "mark"))).alias("m"))
    return rows.select("doc_id", "page", "number", F.array_join(F.transform("m", lambda x: x["mark"].cast("string")), " ").alias("marks"))


def orphan_marks(spark: SparkSession, d: str) -> DataFrame:
    """On documents whose numbers are left out for every third customer."""
    w = words(spark, d)
    third = F.regexp_extract("doc_id", r"\d+", 0).cast("bigint") % 3 == 0
    return marks.orphan_marks(w.filter(~third | (F.col("x0") >= 100))).select("doc_id", "page", "mark", "y", "x")


def _open_parts(spark: SparkSession, d: str) -> DataFrame:
    """Parts a, b, c of each order; those of every fifth question are a bare stem, every fourth (a) has its mark."""
    o = _orders(spark, d).withColumn("k", F.explode(F.when(F.col("no") % 5 == 0, F.array(F.lit(0))).otherwise(F.array(F.lit(1), F.lit(2), F.lit(3)))))
    pid = F.when(F.col("k") == 0, F.col("no").cast("string")).otherwise(F.concat(F.col("no").cast("string"), F.lit("("), F.element_at(F.array(*map(F.lit, "abc")), F.greatest("k", F.lit(1))), F.lit(")")))
    known = F.when((F.col("no") % 4 == 0) & (F.col("k") == 1), F.lit(99))
    return o.select("doc_id", "page", (F.col("no") * 10 + F.col("k")).cast("bigint").alias("ord"), pid.alias("id"), known.cast("int").alias("marks"))


def filled_marks(spark: SparkSession, d: str) -> DataFrame:
    return marks.fill_marks(_open_parts(spark, d), marks.band_marks(words(spark, d))).select("doc_id", "page", "id", "marks")


def rebuilt_lines(spark: SparkSession, d: str) -> DataFrame:
    """A line per order out of words in any order, with header words and dotted lines between."""
    o = _orders(spark, d)
    y = F.col("no") * 40
    parts_ = [(F.lit(200), F.format_string("costs")), (F.lit(300), F.format_number(F.col("o_totalprice").cast("decimal(18,2)"), 2)), (F.lit(100), F.concat(F.lit("Item-"), F.col("no").cast("string"))), (F.lit(400), F.lit("Downloaded")), (F.lit(500), F.lit("17"))]
    w = None
    for x, word in parts_:
        one = _word(o, x, y, F.lit(9), word)
        w = one if w is None else w.unionByName(one)
    w = w.unionByName(_word(o, F.lit(100), y + 20, F.lit(9), F.lit(". . . ."))).unionByName(_word(o, F.lit(120), y + 20, F.lit(9), F.lit("....")))
    return marks.rebuilt_text(w).select("doc_id", "page", "text")


def _rendered(spark: SparkSession, d: str) -> DataFrame:
    """A mark scheme per order: a row per line item under one question cell over all rows; `Or` begins a method at return flag R; every third order ends with its total."""
    li = table(spark, d, "lineitem")
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus")
    li = li.withColumn("rn", F.row_number().over(order)).withColumn("n", F.count("*").over(Window.partitionBy("l_orderkey")))
    answer = F.concat(F.when(F.col("l_returnflag") == "R", "Or x").otherwise("x"), F.lit(" &lt; "), F.col("l_partkey"))
    footer = F.col("l_orderkey") % 3 == 0
    question = F.when(F.col("rn") == 1, F.format_string('<td rowspan="%d">%d(a)</td>', (F.col("n") + footer.cast("int")).cast("int"), (F.col("l_orderkey") % 40 + 1).cast("int"))).otherwise("")
    row = F.concat(F.lit("<tr>"), question, F.lit("<td>"), answer, F.lit("</td><td>M"), F.col("l_linenumber"), F.lit(" A1</td><td>"), F.col("l_linestatus"), F.lit("</td></tr>"))
    by = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("rn", row.alias("row")))).alias("rows"), F.count("*").alias("n"))
    end = F.when(footer, F.format_string("<tr><td>Available marks:</td><td>%d</td><td></td></tr>", (F.col("n") + 7).cast("int"))).otherwise("")
    html = F.concat(F.lit("<table><tr><th>Question</th><th>Answer</th><th>Marks</th><th>Guidance</th></tr>"), F.array_join(F.transform("rows", lambda r: r["row"]), ""), end, F.lit("</table>"))
    return by.select(F.col("l_orderkey").cast("string").alias("doc_id"), F.lit(1).alias("page"), html.alias("markdown"))


def scheme_marks(spark: SparkSession, d: str) -> DataFrame:
    """Marks of rendered schemes: footer totals, else the best method."""
    parts_ = tables.scheme_parts(tables.table_rows(_rendered(spark, d)))
    return parts_.select("doc_id", "id", "marks", F.length("working").alias("n_chars"), "answer", "notes")


def spanned_cells(spark: SparkSession, d: str) -> DataFrame:
    """Question cells over several rows, read back in every row."""
    rows = tables.table_rows(_rendered(spark, d)).filter("row_no > 0")
    return rows.groupBy("doc_id", F.element_at("cells", 1).alias("question")).agg(F.count("*").alias("rows"))


QUERIES = {f.__name__: f for f in (question_number_words, band_marks, question_marks, orphan_marks, filled_marks, rebuilt_lines, scheme_marks, spanned_cells)}

_O = "o AS (SELECT 'c' || o_custkey AS doc_id, CAST(o_orderkey % 3 + 1 AS INTEGER) AS page, o_custkey, o_orderkey, o_orderstatus, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS no FROM orders)"
_B = f"{_O}, b AS (SELECT doc_id, page, o_custkey, CAST(no AS INTEGER) AS number, CAST(l_quantity AS INTEGER) AS mark, CAST(no * 40 + l_linenumber * 3 AS DOUBLE) AS y, CAST(400 + l_quantity AS DOUBLE) AS x FROM lineitem JOIN o ON l_orderkey = o_orderkey)"
_LI = """li AS (SELECT *, row_number() OVER w AS rn FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus)),
  mt AS (SELECT *, sum(CASE WHEN l_returnflag = 'R' AND rn > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey ORDER BY rn) AS m, CASE WHEN l_returnflag = 'R' THEN 'Or x' ELSE 'x' END || ' < ' || l_partkey AS answer FROM li),
  sm AS (SELECT l_orderkey, max(s) AS best FROM (SELECT l_orderkey, m, sum(l_linenumber + 1) AS s FROM mt GROUP BY ALL) GROUP BY l_orderkey)"""

SQL = {
    "question_number_words": f"WITH {_O} SELECT doc_id, page, CAST(no AS INTEGER) AS number, CAST(no * 40 AS DOUBLE) AS y FROM o",
    "band_marks": f"WITH {_B} SELECT doc_id, page, number, mark, y, x FROM b",
    "question_marks": f"WITH {_B} SELECT doc_id, page, number, string_agg(mark, ' ' ORDER BY y, x) AS marks FROM b GROUP BY doc_id, page, number",
    "orphan_marks": f"WITH {_B} SELECT doc_id, page, mark, y, x FROM b WHERE o_custkey % 3 = 0 UNION ALL SELECT doc_id, page, 9, 5.0, 400.0 FROM o WHERE no = 1 AND o_custkey % 3 = 0",
    "filled_marks": f"""WITH {_B}, q AS (SELECT doc_id, page, no, unnest(CASE WHEN no % 5 = 0 THEN [0] ELSE [1, 2, 3] END) AS k FROM o),
      r AS (SELECT doc_id, number, mark, row_number() OVER (PARTITION BY doc_id, number ORDER BY y, x) AS i, count(*) OVER (PARTITION BY doc_id, number) AS n FROM b),
      w AS (SELECT *, CASE WHEN no % 4 = 0 AND k = 1 THEN 99 END AS own, CASE WHEN k = 0 THEN 1 WHEN no % 4 = 0 THEN k - 1 ELSE k END AS place, CASE WHEN k = 0 THEN 1 WHEN no % 4 = 0 THEN 2 ELSE 3 END AS open_ FROM q)
      SELECT w.doc_id, w.page, CASE WHEN k = 0 THEN CAST(no AS VARCHAR) ELSE no || '(' || chr(CAST(96 + k AS INTEGER)) || ')' END AS id, coalesce(own, mark) AS marks
      FROM w LEFT JOIN r ON r.doc_id = w.doc_id AND r.number = w.no AND own IS NULL AND (k > 0 OR r.n = 1) AND r.i = place + greatest(r.n - open_, 0)""",
    "rebuilt_lines": f"WITH {_O} SELECT doc_id, page, string_agg('Item-' || no || ' costs ' || trim(format('{{:,.2f}}', round(o_totalprice, 2))), chr(10) ORDER BY no) AS text FROM o GROUP BY doc_id, page",
    "scheme_marks": f"""WITH {_LI} SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, (l_orderkey % 40 + 1) || '(a)' AS id, CAST(CASE WHEN l_orderkey % 3 = 0 THEN count(*) + 7 ELSE any_value(best) END AS INTEGER) AS marks,
      CAST(length(string_agg(answer, chr(10))) AS INTEGER) AS n_chars, arg_max(answer, rn) AS answer, string_agg(l_linestatus, chr(10) ORDER BY rn) AS notes FROM mt JOIN sm USING (l_orderkey) GROUP BY l_orderkey""",
    "spanned_cells": "SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, (l_orderkey % 40 + 1) || '(a)' AS question, count(*) + CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE 0 END AS rows FROM lineitem GROUP BY l_orderkey",
}
