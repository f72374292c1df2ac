"""Queries p1_ and p2_: nested records and dangling references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators import nested, references
from folioflow.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    a = nested.nodes(table(spark, d, "datasets"), "dataset_id", "questions", ["diagrams"], "datasets")
    b = nested.nodes(table(spark, d, "parts"), "part_id", "diagrams", (), "parts")
    return a.unionByName(b).unionByName(nested.response_nodes(table(spark, d, "ocr_raw")))


def p1_questions(spark: SparkSession, d: str) -> DataFrame:
    q = nested.child_table(table(spark, d, "datasets"), "dataset_id", "questions")
    return q.select("dataset_id", "node", F.col("id").alias("question_id"), "marks", "page", "text", "answer", "working", "notes")


def p1_figures(spark: SparkSession, d: str) -> DataFrame:
    f = nested.child_table(table(spark, d, "datasets"), "dataset_id", "questions", ["diagrams"])
    return f.select("dataset_id", "node", "parent_node", F.col("value").alias("figure"))


def p1_part_figures(spark: SparkSession, d: str) -> DataFrame:
    f = nested.child_table(table(spark, d, "parts"), "part_id", "diagrams")
    return f.select("part_id", "node", F.col("value").alias("figure"))


def p1_elements(spark: SparkSession, d: str) -> DataFrame:
    e = nested.child_table(nested.decoded(table(spark, d, "ocr_raw")), "raw_id", "layout")
    return e.select("raw_id", "node", "label", "content", "x0", "y0", "x1", "y1")


def p1_items(spark: SparkSession, d: str) -> DataFrame:
    """The records inside the elements, at both levels."""
    layouts = nested.decoded(table(spark, d, "ocr_raw"))
    levels = [nested.child_table(layouts, "raw_id", "layout", path) for path in (["items"], ["items", "items"])]
    return levels[0].select("raw_id", "node", "parent_node", "ordinal", "text").unionByName(levels[1].select("raw_id", "node", "parent_node", "ordinal", "text"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return references.dangling_references(*(table(spark, d, n) for n in ("parts", "assets", "datasets", "sources")))


def p2_by_month(spark: SparkSession, d: str) -> DataFrame:
    return p2_found(spark, d).groupBy("src", "period", "reason").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (p1_found, p1_questions, p1_figures, p1_part_figures, p1_elements, p1_items, p2_found, p2_by_month)}

_KEY = r"lower(trim(regexp_replace(url_decode(regexp_replace(trim({0}), '[?#].*$', '')), '^.*[/\\:]', '')))"
_DANGLING = f"""
refs AS (
  SELECT DISTINCT 'parts' AS src, part_id AS rec_id, pos, {_KEY.format("ref")} AS key, loaded_at AS at
  FROM (SELECT part_id, loaded_at, unnest(diagrams) AS ref, unnest(range(1, len(diagrams) + 1)) AS pos FROM parts) WHERE ref <> ''
  UNION ALL
  SELECT DISTINCT 'datasets', dataset_id, 0, {_KEY.format("source_pdf")}, loaded_at FROM datasets WHERE source_pdf <> ''),
targets AS (
  SELECT DISTINCT 'parts' AS src, {_KEY.format("asset_name")} AS key, stored_at AS s, deleted_at AS e FROM assets
  UNION ALL SELECT DISTINCT 'datasets', {_KEY.format("source_pdf")}, registered_at, withdrawn_at FROM sources),
found AS (
  SELECT r.src, r.rec_id, CAST(r.pos AS INTEGER) AS pos, CASE WHEN count(t.key) = 0 THEN 'missing' WHEN min(t.s) > r.at THEN 'late' ELSE 'deleted' END AS reason,
         strftime(r.at, '%Y-%m') AS period
  FROM refs r LEFT JOIN targets t ON t.src = r.src AND t.key = r.key
  GROUP BY r.src, r.rec_id, r.pos, r.key, r.at
  HAVING NOT coalesce(bool_or(t.s <= r.at AND (t.e IS NULL OR t.e > r.at)), false))
"""

SQL = {
    "p1_questions": """
        SELECT dataset_id, CAST(row_number() OVER (PARTITION BY dataset_id ORDER BY i) AS VARCHAR) AS node, q.id AS question_id, q.marks AS marks, q.page AS page,
               q.text AS text, q.answer AS answer, q.working AS working, q.notes AS notes
        FROM (SELECT dataset_id, unnest(questions) AS q, unnest(range(1, len(questions) + 1)) AS i
              FROM (SELECT dataset_id, any_value(questions) AS questions FROM datasets GROUP BY dataset_id)) WHERE q IS NOT NULL""",
    "p1_figures": """
        WITH qs AS (SELECT dataset_id, q, row_number() OVER (PARTITION BY dataset_id ORDER BY i) AS qn
          FROM (SELECT dataset_id, unnest(questions) AS q, unnest(range(1, len(questions) + 1)) AS i
                FROM (SELECT dataset_id, any_value(questions) AS questions FROM datasets GROUP BY dataset_id)) WHERE q IS NOT NULL),
        ds AS (SELECT dataset_id, qn, d, row_number() OVER (PARTITION BY dataset_id, qn ORDER BY i) AS dn
          FROM (SELECT dataset_id, qn, unnest(q.diagrams) AS d, unnest(range(1, len(q.diagrams) + 1)) AS i FROM qs) WHERE d IS NOT NULL)
        SELECT dataset_id, qn || '.' || dn AS node, CAST(qn AS VARCHAR) AS parent_node, d AS figure FROM ds""",
    "p1_part_figures": """
        SELECT part_id, CAST(row_number() OVER (PARTITION BY part_id ORDER BY i) AS VARCHAR) AS node, d AS figure
        FROM (SELECT part_id, unnest(diagrams) AS d, unnest(range(1, len(diagrams) + 1)) AS i
              FROM (SELECT part_id, any_value(diagrams) AS diagrams FROM parts GROUP BY part_id)) WHERE d IS NOT NULL""",
    "p2_found": f"WITH {_DANGLING} SELECT * FROM found",
    "p2_by_month": f"WITH {_DANGLING} SELECT src, period, reason, count(*) AS n FROM found GROUP BY ALL",
}
