"""Queries of the operators in this package."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import confusables, languages, leaks, neardup, scanned, tokens
from folioflow.session import cut_lineage, table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return scanned.defects(table(spark, d, "ocr_pages"), table(spark, d, "parts"))


def p3_repaired(spark: SparkSession, d: str) -> DataFrame:
    pages, parts = table(spark, d, "ocr_pages"), table(spark, d, "parts")
    all_texts = scanned.texts(pages, parts)
    return scanned.repaired(all_texts, scanned.fit(all_texts, pages))


#: Problem 4 in this data: sequences of three words, 30 words at least, a similarity of 0.4.
P4 = {"threshold": 0.4, "k": 3, "least": 30}


def _part_texts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of neardup.MEMBERS: the words of parts, as printed and in one form of characters."""
    pages = table(spark, d, "ocr_pages")
    texts = scanned.part_texts(table(spark, d, "parts")).filter("text is not null")
    # repair never makes more words, so texts of too few words as they stand need none
    long_ = texts.filter(F.regexp_count("text", F.lit(r"[\p{L}\p{N}]+")) >= P4["least"])

    def members(src: pa.Array, ids: pa.Array, whole: list) -> pa.RecordBatch:
        fields = pa.array([s.rsplit(".", 1)[-1] for s in src.to_pylist()], pa.string())
        return neardup.class_rows(fields, ids, whole, max(P4["least"], P4["k"]))

    return scanned.repaired(long_, scanned.fit(texts, pages), members, neardup.MEMBERS)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    found = neardup.all_pairs(*neardup.near_duplicates(_part_texts(spark, d), **P4))
    return found.select("field", F.col("id_a").alias("part_id_a"), F.col("id_b").alias("part_id_b"))


def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    """Every long enough text with its group and its number of links to other texts."""
    found = neardup.groups(*neardup.near_duplicates(_part_texts(spark, d), **P4))
    return found.select("field", F.col("id").alias("part_id"), "group_id", "links")


def p4_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of representatives of different texts, with their similarity; p4_members has whom they stand for."""
    pairs, _ = neardup.near_duplicates(_part_texts(spark, d), **P4)
    return pairs.select("field", F.least("a", "b").alias("part_id_a"), F.greatest("a", "b").alias("part_id_b"), F.round("similarity", 4).alias("similarity"))


def p4_members(spark: SparkSession, d: str) -> DataFrame:
    """Every long enough text with the representative of its class of equal texts."""
    _, members = neardup.near_duplicates(_part_texts(spark, d), **P4)
    return members.select("field", F.col("id").alias("part_id"), "rep")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return confusables.found(table(spark, d, "parts"))


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    return confusables.groups(table(spark, d, "parts"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encoded(table(spark, d, "documents"))


def p6_decoded(spark: SparkSession, d: str) -> DataFrame:
    """Round trip: (doc_id, text) decoded from the ids; null texts come back empty."""
    return tokens.decoded(tokens.encoded(table(spark, d, "documents")))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p7_refilled(spark: SparkSession, d: str) -> DataFrame:
    """Pairs that p7_found doesn't have: the item stands in the document with other numbers, names or units."""
    return leaks.refilled(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p7_by_item(spark: SparkSession, d: str) -> DataFrame:
    """Which items leaked, and into how many documents."""
    items = table(spark, d, "eval_items").select("item_id", "suite").distinct()
    return p7_found(spark, d).groupBy("item_id").agg(F.count("*").alias("documents")).join(items, "item_id").select("item_id", "suite", "documents")


def p8_segments(spark: SparkSession, d: str) -> DataFrame:
    """Every segment of every document, with its confidence."""
    rows = languages.document_segments(table(spark, d, "documents"), table(spark, d, "lang_samples"))
    return rows.select("doc_id", "label", "seg_no", "lang", "confidence", "letters")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    rows = languages.document_segments(table(spark, d, "documents"), table(spark, d, "lang_samples"))
    return languages.needs_label(cut_lineage(rows.drop("text"))).select("doc_id", "seg_no", "lang")


def p8_documents(spark: SparkSession, d: str) -> DataFrame:
    """One language with a confidence for each document: that of most of its letters."""
    rows = p8_segments(spark, d).groupBy("doc_id", "lang").agg(F.sum("letters").alias("n"), F.sum(F.col("confidence") * F.col("letters")).alias("c"))
    best = rows.groupBy("doc_id").agg(F.max_by("lang", F.struct("n", "lang")).alias("lang"), F.max_by("c", F.struct("n", "lang")).alias("c"), F.sum("n").alias("n"))
    return best.select("doc_id", "lang", F.round(F.col("c") / F.col("n"), 4).alias("confidence"))


QUERIES = {f.__name__: f for f in (p3_found, p3_repaired, p4_found, p4_groups, p4_pairs, p4_members, p5_found, p5_groups, p6_ids, p6_decoded, p7_found, p7_refilled, p7_by_item, p8_found, p8_segments, p8_documents)}
SQL: dict[str, str] = {
    "p6_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
