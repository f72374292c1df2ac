"""Cells over several rows and columns, laid out for many tables at once.

Tables come as Arrow lists of rows of cells. All of them advance together,
row by row and column by column: which cell stands at a place is decided for
every table by one vectorised step, and the texts are taken at the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Marks in a layout: an empty place, and one beyond the end of its row.
EMPTY, NONE = -1, -2


def _largest(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The largest of each stretch of values; 0 for an empty one or where all are less."""
    out = np.zeros(len(offsets) - 1, np.int64)
    np.maximum.at(out, np.repeat(np.arange(len(out)), np.diff(offsets)), values)
    return out


def layout(rows: np.ndarray, cells: np.ndarray, down: np.ndarray, across: np.ndarray) -> np.ndarray:
    """Which cell stands where: a line per row and a column per place, by the cell's number, EMPTY or NONE.

    rows, cells: offsets of the tables' rows and of the rows' cells.
    A table is as wide as its widest row. A cell hangs down into the rows below
    at its first column; a row as wide as the table lets nothing hang into it.
    """
    total = np.concatenate([[0], np.cumsum(across)])
    wide = total[cells[1:]] - total[cells[:-1]]
    width, height = _largest(wide, rows), np.diff(rows)
    own = np.maximum(across, 1)
    places = int(width.max(initial=0) + own.max(initial=1) - 1)
    out = np.full((len(wide), places), NONE, np.int64)
    left = np.zeros((len(width), places), np.int64)
    hanging = np.full((len(width), places), EMPTY, np.int64)
    for r in range(int(height.max(initial=0))):
        table = np.flatnonzero(height > r)
        row = rows[table] + r
        left[table[wide[row] >= width[table]]] = 0
        cell, end, tail = cells[row].copy(), cells[row + 1], np.zeros(len(row), np.int64)
        for c in range(places):
            inside = c < width[table]
            hangs = (tail == 0) & inside & (left[table, c] > 0)
            new = (tail == 0) & inside & ~hangs & (cell < end)
            at = np.full(len(row), NONE)
            at[(tail > 0) | inside] = EMPTY
            at[hangs] = hanging[table[hangs], c]
            at[new] = cell[new]
            left[table[hangs], c] -= 1
            tail = np.maximum(tail - 1, 0)
            tail[new] = own[cell[new]] - 1
            deep = new.copy()
            deep[new] = down[cell[new]] > 1
            left[table[deep], c], hanging[table[deep], c] = down[cell[deep]] - 1, cell[deep]
            cell += new
            out[row, c] = at
    return out


def _offsets(lists: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Offsets from 0 and the values between them; a null list is an empty one."""
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.concatenate([[0], np.cumsum(n)]), lists.flatten()


def _nested(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


@F.arrow_udf(T.ArrayType(T.ArrayType(T.ArrayType(T.StringType()))))
def spread(pages: pa.Array) -> pa.Array:
    """The grid of each table of each page. A cell: text, down, across."""
    if pages.null_count == len(pages):
        return pa.nulls(len(pages), pa.list_(pa.list_(pa.list_(pa.string()))))
    tables, tables_in = _offsets(pages)
    rows, rows_in = _offsets(tables_in)
    cells, cells_in = _offsets(rows_in)
    number = lambda name: cells_in.field(name).to_numpy(zero_copy_only=False).astype(np.int64)
    at = layout(rows, cells, number("down"), number("across"))
    lines = np.concatenate([[0], np.cumsum((at != NONE).sum(axis=1))]) if at.size else np.zeros(len(cells), np.int64)
    flat = at[at != NONE]
    texts = pc.fill_null(cells_in.field("text").take(pa.array(flat, mask=flat == EMPTY)), "")
    return _nested(tables, _nested(rows, _nested(lines, texts)))


#: Planned as if it weren't deterministic, so that Spark neither repeats it in an inferred filter nor moves it into a lambda.
spread = spread.asNondeterministic()
