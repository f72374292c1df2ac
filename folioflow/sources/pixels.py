"""Work on the pixels of page images: ruled tables and crops."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.functions import geometry as g
from folioflow.functions import png
from folioflow.functions.text import asset_name

#: A stroke is at least this share of the page's side; a table's least share of its area, width and height.
STROKE, TABLE_AREA, TABLE_WIDTH, TABLE_HEIGHT = 1 / 40, 0.01, 0.1, 0.02
BOXES = T.ArrayType(T.StructType([T.StructField(n, T.DoubleType()) for n in g.CORNERS]))


def ink(image: bytes) -> np.ndarray:
    """Where the page is dark: the grey level that parts light from dark best (largest variance between the two)."""
    pixels = png.decode(image)
    grey = pixels[..., 0].astype(np.float64) if pixels.shape[2] < 3 else pixels[..., :3] @ np.array([0.299, 0.587, 0.114])
    grey = np.round(grey).astype(np.uint8)
    n = np.bincount(grey.ravel(), minlength=256).astype(np.float64)
    dark, light = np.cumsum(n), n.sum() - np.cumsum(n)
    level = np.cumsum(n * np.arange(256))
    with np.errstate(divide="ignore", invalid="ignore"):
        between = dark * light * (level / dark - (level[-1] - level) / light) ** 2
    return grey <= int(np.argmax(np.nan_to_num(between)))


def strokes(dark: np.ndarray, least: int) -> np.ndarray:
    """The dark runs of at least so many pixels along each row."""
    edge = np.diff(np.pad(dark.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    rows, starts = np.nonzero(edge == 1)
    ends = np.nonzero(edge == -1)[1]
    long_ = ends - starts >= least
    out = np.zeros((dark.shape[0], dark.shape[1] + 1), np.int8)
    out[rows[long_], starts[long_]] = 1
    out[rows[long_], ends[long_]] = -1
    return np.cumsum(out, axis=1)[:, :-1] > 0


def connected_boxes(marked: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Boxes (x0, y0, x1, y1) around the connected regions, diagonals included. Runs of a row join those they touch in the row above."""
    edge = np.diff(np.pad(marked.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    rows, starts = np.nonzero(edge == 1)
    ends = np.nonzero(edge == -1)[1]
    of = list(range(len(rows)))

    def root(i: int) -> int:
        while of[i] != i:
            of[i] = of[of[i]]
            i = of[i]
        return i

    first = np.searchsorted(rows, np.arange(marked.shape[0] + 1))
    for y in range(1, marked.shape[0]):
        i, j = first[y - 1], first[y]
        while i < first[y] and j < first[y + 1]:
            if starts[i] <= ends[j] and starts[j] <= ends[i]:
                of[root(j)] = root(i)
            if ends[i] < ends[j]:
                i += 1
            else:
                j += 1
    boxes: dict[int, tuple[int, int, int, int]] = {}
    for i, (y, a, b) in enumerate(zip(rows.tolist(), starts.tolist(), ends.tolist())):
        x0, y0, x1, y1 = boxes.get(root(i), (a, y, b, y + 1))
        boxes[root(i)] = (min(x0, a), min(y0, y), max(x1, b), max(y1, y + 1))
    return list(boxes.values())


def ruled_tables(image: bytes) -> list[tuple[float, float, float, float]]:
    """Boxes of ruled tables: long horizontal and vertical strokes together, large enough."""
    dark = ink(image)
    height, width = dark.shape
    both = strokes(dark, max(10, int(width * STROKE))) | strokes(dark.T, max(10, int(height * STROKE))).T
    found = [(x1 - x0, y1 - y0, (float(x0), float(y0), float(x1), float(y1))) for x0, y0, x1, y1 in connected_boxes(both)]
    return [box for w, h, box in found if w * h >= TABLE_AREA * width * height and w > TABLE_WIDTH * width and h > TABLE_HEIGHT * height]


@F.arrow_udf(BOXES)
def detected_boxes(images: pa.Array) -> pa.Array:
    """The ruled tables of each page image; null for a null or unreadable one."""
    out = []
    for image in images.to_pylist():
        try:
            out.append(None if image is None else [dict(zip(g.CORNERS, b)) for b in ruled_tables(image)])
        except ValueError:
            out.append(None)
    return pa.array(out, pa.list_(pa.struct([(n, pa.float64()) for n in g.CORNERS])))


def crop(image: bytes, box: tuple[int, int, int, int]) -> bytes:
    """The region as PNG; an empty one is a white pixel."""
    x0, y0, x1, y1 = box
    pixels = png.decode(image)
    piece = pixels[y0:y1, x0:x1]
    return png.encode(piece if piece.size else np.full((1, 1, pixels.shape[2]), 255, np.uint8))


def figure_images(pages: DataFrame, least: float = g.MIN_FIGURE_AREA) -> DataFrame:
    """(doc_id, page, fig_no, asset, content): the figures of pages (doc_id, page, width, height, elements, image) that are large enough, cut out."""
    boxes = g.large_figures(F.col("elements"), F.col("width"), F.col("height"), least)
    corners = F.transform(boxes, lambda b: g.crop_corners(b, F.col("width"), F.col("height")))
    rows = pages.select("doc_id", "page", "image", corners.alias("boxes")).filter((F.size("boxes") > 0) & F.col("image").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc_id, page, image, found in zip(*(c.to_pylist() for c in b.columns)):
                out += [(doc_id, page, n, crop(image, tuple(box[c] for c in g.CORNERS))) for n, box in enumerate(found, 1)]
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, kinds)], ["doc_id", "page", "fig_no", "content"])

    cut = rows.mapInArrow(run, "doc_id string, page int, fig_no int, content binary")
    return cut.select("doc_id", "page", "fig_no", _asset().alias("asset"), "content")


def _asset() -> Column:
    return asset_name(F.col("doc_id"), F.col("page"), F.col("fig_no"))
