"""Boxes: struct<x0, y0, x1, y1>, in pixels or points, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Labels of tables and figures; thresholds.
TABLES, IMAGES = ("table", "table_full"), ("image", "figure", "picture", "chart")
MIN_FIGURE_AREA, RESCUE_MAX_AREA, MERGE_IOU, RELATIVE = 0.015, 0.5, 0.2, 1.01
CORNERS = ("x0", "y0", "x1", "y1")


def box(*corners: Column) -> Column:
    return F.struct(*[c.cast("double").alias(n) for n, c in zip(CORNERS, corners)])


def _each(b: Column, f) -> Column:
    return box(*[f(b[n], i) for i, n in enumerate(CORNERS)])


def points_to_pixels(b: Column, scale: Column) -> Column:
    return _each(b, lambda c, _: c * scale)


def pixels_to_points(b: Column, scale: Column) -> Column:
    return _each(b, lambda c, _: c / scale)


def is_table(label: Column) -> Column:
    return F.coalesce(F.lower(label).isin(*TABLES), F.lit(False))


def is_image(label: Column) -> Column:
    return F.coalesce(F.lower(label).isin(*IMAGES), F.lit(False))


def boxes_of(elements: Column, test) -> Column:
    """Boxes of the elements with a label of the kind; null elements and boxes have none."""
    there = F.filter(elements, lambda e: e.isNotNull() & e["bbox"].isNotNull() & test(e["label"]))
    return F.coalesce(F.transform(there, lambda e: e["bbox"]), F.array().cast("array<struct<x0:double,y0:double,x1:double,y1:double>>"))


def denormalised(boxes: Column, width: Column, height: Column) -> Column:
    """Scaled to the page if every coordinate of every box is relative; else as they are."""
    relative = F.forall(boxes, lambda b: F.greatest(*[b[n] for n in CORNERS]) <= RELATIVE)
    sides = (width, height, width, height)
    return F.when(relative, F.transform(boxes, lambda b: _each(b, lambda c, i: c * sides[i]))).otherwise(F.transform(boxes, lambda b: _each(b, lambda c, _: c)))


def area(b: Column) -> Column:
    return (b["x1"] - b["x0"]) * (b["y1"] - b["y0"])


def area_fraction(b: Column, width: Column, height: Column) -> Column:
    page = (width * height).cast("double")
    return area(b) / F.when(page == 0, 1.0).otherwise(page)


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 where the union is empty."""
    zero = F.lit(0.0)
    w = F.greatest(zero, F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]))
    h = F.greatest(zero, F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))
    union = area(a) + area(b) - w * h
    return F.when(union > 0, w * h / union).otherwise(0.0)


def envelope(a: Column, b: Column) -> Column:
    return box(F.least(a["x0"], b["x0"]), F.least(a["y0"], b["y0"]), F.greatest(a["x1"], b["x1"]), F.greatest(a["y1"], b["y1"]))


def merged(boxes: Column, least: float = MERGE_IOU) -> Column:
    """In order, each box widens the first kept box it overlaps by more than `least`, else is kept itself."""
    empty = F.array().cast("array<struct<x0:double,y0:double,x1:double,y1:double>>")

    def step(kept: Column, b: Column) -> Column:
        hit = F.array_position(F.transform(kept, lambda k: iou(k, b) > least), True)
        widened = F.transform(kept, lambda k, i: F.when(i + 1 == hit, envelope(k, b)).otherwise(k))
        return F.when(hit > 0, widened).otherwise(F.concat(kept, F.array(b)))

    return F.aggregate(boxes, empty, step)


def crop_corners(b: Column, width: Column, height: Column) -> Column:
    """Rounded half to even and clamped to the image; an empty crop is one pixel at its corner."""
    x = lambda c: F.greatest(F.lit(0), F.least(F.bround(c).cast("int"), width))
    y = lambda c: F.greatest(F.lit(0), F.least(F.bround(c).cast("int"), height))
    return F.struct(x(b["x0"]).alias("x0"), y(b["y0"]).alias("y0"), x(b["x1"]).alias("x1"), y(b["y1"]).alias("y1"))


def large_figures(elements: Column, width: Column, height: Column, least: float = MIN_FIGURE_AREA) -> Column:
    """Boxes of the page's figures that are large enough, in element order."""
    found = denormalised(boxes_of(elements, is_image), width, height)
    return F.filter(found, lambda b: area_fraction(b, width, height) >= least)


def part_index(b: Column, height: Column, n: Column) -> Column:
    """Which of n parts of a page (from 0) a figure belongs to by its middle."""
    fraction = F.least(F.greatest((b["y0"] + b["y1"]) / 2.0 / F.greatest(height.cast("double"), F.lit(1.0)), F.lit(0.0)), F.lit(0.999))
    return F.floor(fraction * n).cast("int")
