"""From PDF files to datasets: rendering, two OCR passes, text layer, segmentation, figures."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.config import Config
from folioflow.functions import geometry as g
from folioflow.operators import layout, parts, validate
from folioflow.session import cut_lineage
from folioflow.sources import files, ocr, pixels


@dataclass
class Result:
    """datasets: one nested row per document; figures: (doc_id, page, fig_no, asset, content); cache: the responses that were new."""

    datasets: DataFrame
    pages: DataFrame
    figures: DataFrame
    cache: DataFrame


def read_pages(pdfs: DataFrame, config: Config, cache: DataFrame | None, client: ocr.Client | None = None, opener: Callable = files.open_pdf) -> tuple[DataFrame, DataFrame]:
    """The pages with what the first pass reads on them, and the responses asked for."""
    images = cut_lineage(files.page_images(pdfs, config.page_dpi, opener))
    asked = cut_lineage(ocr.with_cache(images.select("doc_id", "page", "modified", "image"), cache, config, "pass1", client))
    read = asked.select("key", "doc_id", "page").join(ocr.normalised(asked, "key", "response"), "key").drop("key")
    pages = images.join(read, ["doc_id", "page"]).withColumn("page_id", F.xxhash64("doc_id", "page"))
    return cut_lineage(pages), asked


def second_pass(pages: DataFrame, words: DataFrame, pdfs: DataFrame, config: Config, cache: DataFrame | None, client: ocr.Client | None = None, opener: Callable = files.open_pdf) -> tuple[DataFrame, DataFrame]:
    """(doc_id, page, region_no, markdown) of the table regions read again at a higher resolution, and the responses asked for.

    Where the model has found no table, ruled ones are looked for on the image.
    """
    none = F.size(g.boxes_of(F.col("elements"), g.is_table)) == 0
    text = parts.with_text_layer(pages, words).withColumn("detected", pixels.detected_boxes(F.when(none, F.col("image"))))
    regions = layout.rescue_regions(text, config.table_rescue, config.rescue_max_area, F.coalesce("detected", F.array().cast(pixels.BOXES)))
    due = cut_lineage(regions.filter("rescue").select("doc_id", "page", "region_no", "box").join(pages.select("doc_id", "page", "scale"), ["doc_id", "page"]))
    clips = files.page_clips(pdfs, due.select("doc_id", "page", "region_no", g.pixels_to_points(F.col("box"), F.col("scale")).alias("box")), config.table_dpi, opener)
    rounded = F.format_string("%.1f %.1f %.1f %.1f", *[F.col(f"box.{c}") for c in g.CORNERS]).alias("place")
    clips = clips.join(due.select("doc_id", "page", "region_no", rounded), ["doc_id", "page", "region_no"])
    asked = cut_lineage(ocr.with_cache(clips, cache, config, "pass2", client, ("region_no", "place"), ("place",)))
    read = asked.select("key", "doc_id", "page", "region_no").join(ocr.normalised(asked, "key", "response"), "key")
    return read.select("doc_id", "page", "region_no", "markdown"), asked


def read_documents(pdfs: DataFrame, config: Config, cache: DataFrame | None = None, client: ocr.Client | None = None, opener: Callable = files.open_pdf, command: list[str] | None = None) -> Result:
    """pdfs: (doc_id, modified, content). command: the math renderer, this package's own unless another is given."""
    pages, first = read_pages(pdfs, config, cache, client, opener)
    words = cut_lineage(files.page_words(pdfs, opener))
    rescued, second = second_pass(pages, words, pdfs, config, cache, client, opener)
    made = cut_lineage(parts.datasets(pages, words, rescued, command=validate.renderer() if command is None else command, least_figure=config.min_figure_area))
    new = first.select("key", "response").unionByName(second.select("key", "response"))
    fresh = new if cache is None else new.join(cache.select("key"), "key", "left_anti")
    return Result(made, pages, pixels.figure_images(pages, config.min_figure_area), ocr.cache_rows(fresh))
