"""Table regions of pages: resolved boxes and the ones worth a second look."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions import geometry as g
from folioflow.operators import tables


def table_boxes(detected: Column | None = None) -> Column:
    """Boxes of the layout model, relative ones scaled, overlapping ones merged; detected boxes only where the model has none."""
    own = g.merged(g.denormalised(g.boxes_of(F.col("elements"), g.is_table), F.col("width"), F.col("height")))
    return own if detected is None else F.when(F.size(own) > 0, own).otherwise(g.merged(detected))


def rescue_regions(pages: DataFrame, enabled: bool = True, max_area: float = g.RESCUE_MAX_AREA, detected: Column | None = None) -> DataFrame:
    """(page_id, doc_id, page, region_no, box, rescue): every table region in order, and whether a second OCR pass is due.

    None is where rescue is off, the page already has a mark scheme, or the
    region covers more than max_area of the page. The expensive pass then runs on the filtered rows only.
    """
    schemes = tables.table_rows(pages).filter((F.col("row_no") == 0) & tables.is_mark_scheme(F.col("header"))).select("doc_id", "page").distinct().withColumn("scheme", F.lit(True))
    rows = pages.select("page_id", "doc_id", "page", "width", "height", F.posexplode(table_boxes(detected)).alias("i", "box"))
    small = g.area_fraction(F.col("box"), F.col("width"), F.col("height")) <= max_area
    out = rows.join(schemes, ["doc_id", "page"], "left")
    return out.select("page_id", "doc_id", "page", (F.col("i") + 1).alias("region_no"), "box", (F.lit(enabled) & F.col("scheme").isNull() & small).alias("rescue"))
