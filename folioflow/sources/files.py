"""Files in: PDFs, rendered pages, dataset JSON.

The functions on PDFs open each file once per row with `open_pdf`, which is
PyMuPDF's unless another is given: an object that yields pages with `rect`,
`get_pixmap(dpi=, alpha=, clip=)` and `get_text("words")`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.text import safe_stem
from folioflow.schemas import DATASET, PAGE_IMAGE, WORD


def pdf_files(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, modified, length, content, doc_id) of the PDFs in folders (not below them) or named singly; other files are skipped."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").load(list(paths))
    return files.select("path", F.col("modificationTime").alias("modified"), "length", "content", safe_stem(F.col("path")).alias("doc_id"))


def open_pdf(content: bytes):
    import fitz  # PyMuPDF, where it is installed

    return fitz.open(stream=content, filetype="pdf")


def page_images(pdfs: DataFrame, dpi: int = 200, opener: Callable = open_pdf) -> DataFrame:
    """One row per rendered page, in scale dpi / 72."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for doc_id, modified, content in zip(b.doc_id, b.modified, b.content):
                with opener(bytes(content)) as pdf:
                    for i, page in enumerate(pdf, 1):
                        pix = page.get_pixmap(dpi=dpi, alpha=False)
                        yield pd.DataFrame([(doc_id, modified, i, pix.tobytes("png"), dpi / 72, pix.width, pix.height)], columns=["doc_id", "modified", "page", "image", "scale", "width", "height"])

    return pdfs.select("doc_id", "modified", "content").mapInPandas(run, PAGE_IMAGE)


def page_clips(pdfs: DataFrame, regions: DataFrame, dpi: int = 300, opener: Callable = open_pdf) -> DataFrame:
    """(doc_id, modified, page, region_no, image) of regions (doc_id, page, region_no, box in points). A file is opened once for all its regions."""
    one = F.collect_list(F.struct("page", "region_no", F.col("box.x0").alias("x0"), F.col("box.y0").alias("y0"), F.col("box.x1").alias("x1"), F.col("box.y1").alias("y1")))
    rows = regions.groupBy("doc_id").agg(one.alias("regions")).join(pdfs.select("doc_id", "modified", "content"), "doc_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for doc_id, regions, modified, content in zip(b.doc_id, b.regions, b.modified, b.content):
                with opener(bytes(content)) as pdf:
                    pages = list(pdf)
                    for r in regions:
                        pix = pages[r["page"] - 1].get_pixmap(dpi=dpi, alpha=False, clip=[r[k] for k in ("x0", "y0", "x1", "y1")])
                        yield pd.DataFrame([(doc_id, modified, r["page"], r["region_no"], pix.tobytes("png"))], columns=["doc_id", "modified", "page", "region_no", "image"])

    return rows.select("doc_id", "regions", "modified", "content").mapInPandas(run, "doc_id string, modified timestamp, page int, region_no int, image binary")


def page_words(pdfs: DataFrame, opener: Callable = open_pdf) -> DataFrame:
    """The positioned words of the text layer; a page that can't be read has none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for doc_id, content in zip(b.doc_id, b.content):
                rows = []
                with opener(bytes(content)) as pdf:
                    for i, page in enumerate(pdf, 1):
                        try:
                            rows += [(doc_id, i, float(page.rect.width), float(page.rect.height), *map(float, w[:4]), w[4]) for w in page.get_text("words")]
                        except Exception:
                            continue
                yield pd.DataFrame(rows, columns=["doc_id", "page", "width", "height", "x0", "y0", "x1", "y1", "word"])

    return pdfs.select("doc_id", "content").mapInPandas(run, WORD)


def read_datasets(spark: SparkSession, folder: str, keep_broken: bool = False) -> DataFrame:
    """Dataset JSON files with `path`. Unreadable files are left out, or kept with `broken` for a report."""
    raw = spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    parsed = raw.select("path", F.from_json("value", DATASET + ", _corrupt_record string", {"mode": "PERMISSIVE"}).alias("d"))
    rows = parsed.select("d.*", "path").withColumn("broken", F.col("_corrupt_record").isNotNull()).drop("_corrupt_record")
    return rows if keep_broken else rows.filter("not broken").drop("broken")


def image_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content) of the PNG files in a folder, path as a dataset names them: the file name, or with folders before it."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][nN][gG]").load(folder).select("path", "content")
