"""Queries over OCR responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.session import table
from folioflow.sources import ocr


def _normalised(spark: SparkSession, d: str) -> DataFrame:
    return ocr.normalised(table(spark, d, "ocr_raw").dropDuplicates(["raw_id"]))


def normalised_responses(spark: SparkSession, d: str) -> DataFrame:
    return _normalised(spark, d).select("raw_id", F.length("markdown").alias("n_chars"), F.size("elements").alias("n_elements"))


def response_elements(spark: SparkSession, d: str) -> DataFrame:
    rows = _normalised(spark, d).select("raw_id", F.posexplode("elements").alias("i", "e"))
    return rows.select("raw_id", (F.col("i") + 1).alias("n"), F.col("e.label").alias("label"), *[F.col(f"e.bbox.{c}").alias(c) for c in ("x0", "y0", "x1", "y1")], F.col("e.content").alias("content"))


QUERIES = {f.__name__: f for f in (normalised_responses, response_elements)}
SQL: dict[str, str] = {}
