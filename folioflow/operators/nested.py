"""Nested records as flat tables with keys of parent and child.

The work is done on Arrow buffers: the offsets of a list column give the
parent index of every child, nulls are filtered out, keys travel by `take`.
No row is looked at singly. The JSON text of OCR responses, whose shape differs
from row to row, is first read into one typed list column by Spark's parser.

Edge cases (all operators here): a null list, an empty list and a list of
nulls have no children; an empty string is a child; repeated rows give their
children once; fields named like a link column get a trailing underscore.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from folioflow.functions import responses as r

# -- Arrow kernels ---------------------------------------------------------


def children(lists: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Parent index, value and number (from 1) of each non-null child of a list column."""
    parents, values = pc.list_parent_indices(lists), pc.list_flatten(lists)
    if values.null_count:
        there = pc.is_valid(values)
        parents, values = parents.filter(there), values.filter(there)
    p = parents.to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.arange(len(p))
    new = np.ones(len(p), bool)
    new[1:] = p[1:] != p[:-1]
    number = at - np.maximum.accumulate(np.where(new, at, 0)) + 1 if len(p) else at
    return pa.array(p), values, number.astype(np.int32)


def joined_node(parent: pa.Array | None, number: np.ndarray) -> pa.Array:
    text = pc.cast(pa.array(number), pa.string())
    return text if parent is None else pc.binary_join_element_wise(parent, text, ".")


def _field(values: pa.Array, name: str) -> pa.Array:
    """A field of a struct column, its own nulls included."""
    return pc.struct_field(values, name)


def levels(lists: pa.Array, keys: pa.Array, path: list[str]) -> Iterator[tuple[pa.Array, pa.Array, pa.Array | None, np.ndarray, pa.Array]]:
    """(key, node, parent node, number, values) of each level: the list itself, then the list fields along path."""
    node = None
    for name in [None, *path]:
        if name is not None:
            lists = _field(lists, name)
        parents, values, number = children(lists)
        keys = keys.take(parents)
        above = None if node is None else node.take(parents)
        node = joined_node(above, number)
        yield keys, node, above, number, values
        lists = values


# -- operators on DataFrames -----------------------------------------------


def nodes(df: DataFrame, key: str, column: str | Column, path: list[str] = (), src: str = "") -> DataFrame:
    """One row (src, rec_id, node) for each nested record of a list column, at every level of path."""
    data = df.select(F.col(key).alias("rec_id"), (F.col(column) if isinstance(column, str) else column).alias("lists"))
    path = list(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, lists = b.column(0), b.column(1)
            for k, node, _, _, _ in levels(lists, keys, path):
                yield pa.RecordBatch.from_arrays([k, node], ["rec_id", "node"])

    out = data.mapInArrow(run, "rec_id bigint, node string")
    return out.distinct().select(F.lit(src).alias("src"), "rec_id", "node")


def _scalar_fields(t: T.DataType, links: set[str]) -> list[tuple[str, str, T.DataType]]:
    if not isinstance(t, T.StructType):
        return [("value", "value", t)]
    out, taken = [], {x.lower() for x in links}
    for f in t.fields:
        if not isinstance(f.dataType, T.ArrayType):
            name = f.name
            while name.lower() in taken:
                name += "_"
            taken.add(name.lower())
            out.append((f.name, name, f.dataType))
    return out


def child_table(df: DataFrame, key: str, column: str, path: list[str] = ()) -> DataFrame:
    """The flat table at the end of path: key, node, parent_node, ordinal and the record's own fields.

    parent_node is null for records directly in the column. Lists inside the
    records are left to a child table of their own.
    """
    path = list(path)
    t = df.schema[column].dataType.elementType
    for name in path:
        t = t[name].dataType.elementType
    key_type = df.schema[key].dataType
    links = {key, "node", "parent_node", "ordinal"}
    fields = _scalar_fields(t, links)
    schema = T.StructType(
        [T.StructField(key, key_type), T.StructField("node", T.StringType()), T.StructField("parent_node", T.StringType()), T.StructField("ordinal", T.IntegerType())]
        + [T.StructField(out, kind) for _, out, kind in fields]
    )
    plain = not isinstance(t, T.StructType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for keys, node, above, number, values in levels(b.column(1), b.column(0), path):
                last = (keys, node, above, number, values)
            keys, node, above, number, values = last
            cols = [values] if plain else [_field(values, name) for name, _, _ in fields]
            above = pa.nulls(len(keys), pa.string()) if above is None else above
            yield pa.RecordBatch.from_arrays([keys, node, above, pa.array(number), *cols], [f.name for f in schema.fields])

    rows = df.select(key, column).mapInArrow(run, schema)
    return rows.dropDuplicates([key, "node"])


# -- OCR responses ----------------------------------------------------------


def _loads(s: str):
    try:
        return json.loads(s)
    except (ValueError, RecursionError):
        return None


def _layout(v):
    """The layout list wherever the envelope keeps it, level by level; else None. For what lies deeper than the expressions go."""
    open_ = deque([v])
    while open_:
        v = open_.popleft()
        if isinstance(v, str) and v.lstrip()[:1] in ("{", "[", '"'):
            open_.append(_loads(v))
        elif isinstance(v, dict):
            for name in r.LAYOUT:
                x = v.get(name)
                x = _loads(x) if isinstance(x, str) else x
                if isinstance(x, list):
                    return x
            open_.extend(v[k] for k in sorted(v))
        elif isinstance(v, list):
            open_.extend(v)
    return None


def _objects(v: list) -> list[dict]:
    """The objects of a list, those of inner lists included, in order."""
    out, open_ = [], [v]
    while open_:
        x = open_.pop()
        if isinstance(x, dict):
            out.append(x)
        elif isinstance(x, list):
            open_.extend(reversed(x))
    return out


def _plain(v) -> str:
    return v if isinstance(v, str) else json.dumps(v, ensure_ascii=False, separators=(",", ":"))


def _parts(o: dict) -> tuple[str | None, list[dict], list[tuple[str, str]]]:
    """Name and objects of the one list of objects, and the other fields as texts."""
    name = next((k for k in sorted(o) if isinstance(o[k], list) and any(isinstance(x, dict) for x in o[k])), None)
    inner = [x for x in o[name] if isinstance(x, dict)] if name is not None else []
    return name, inner, [(k, _plain(v)) for k, v in sorted(o.items()) if k != name and v is not None]


def _text(o: dict, names: tuple[str, ...]) -> str | None:
    return next((v for n in names if isinstance(v := o.get(n), str) and v), None)


def _box(o: dict) -> list[float] | None:
    b = next((o[n] for n in r.BOX if isinstance(o.get(n), list)), None)
    return [float(x) for x in b] if b and all(isinstance(x, (int, float)) for x in b) else None


def decode_layout(raw: str | None) -> list[dict] | None:
    """The typed layout of one response; null for a null, cut-off or foreign text."""
    found = None if raw is None else _layout(_loads(raw))
    if found is None:
        return None
    out = []
    for o in _objects(found):
        name, inner, rest = _parts(o)
        items = []
        for i in inner:
            sub, leaves, attrs = _parts(i)
            items.append({"text": _text(i, r.INNER_TEXT), "list_name": sub, "attrs": attrs, "items": [{"text": _text(x, r.INNER_TEXT), "attrs": [(k, _plain(v)) for k, v in sorted(x.items()) if v is not None]} for x in leaves]})
        out.append({"label": _text(o, r.LABEL), "content": _text(o, r.CONTENT), **dict(zip(r.CORNERS, [*(_box(o) or ()), *[None] * 4])), "list_name": name, "attrs": rest, "items": items})
    return out


def decoded(df: DataFrame, key: str = "raw_id", column: str = "raw", shape: bool = False) -> DataFrame:
    """(key, layout) of each response: typed elements, or with `shape` only how they nest.

    Spark's parser reads texts whose envelopes go down r.DEPTH levels; the few
    that go deeper are read by a stack, to any depth that is still JSON for the
    parsers (1,000 levels). Null, cut-off and foreign texts have no elements.
    """
    typed = r.shapes if shape else r.elements
    read = df.select(key, F.col(column).alias("raw_"), r.layout(F.col(column)).alias("read_"))
    read = read.select(key, F.when(~F.col("read_.deep"), typed(F.col("read_.elements"))).alias("layout"), F.when(F.col("read_.deep"), F.col("raw_")).alias("raw_"))

    def by_stack(raw: str) -> list | None:
        x = decode_layout(raw)
        return x and [{"items": [{"items": [True] * len(i["items"])} for i in e["items"]]} for e in x] if shape else x

    return with_deep_ones(read, {"layout": by_stack})


def with_deep_ones(read: DataFrame, fix: dict[str, Callable[[str], object]]) -> DataFrame:
    """read without its column raw_: where that holds a text, too deep for the expressions, the columns of fix are worked out from it; all other rows pass as they are."""
    names = [c for c in read.columns if c != "raw_"]
    kinds = {c: to_arrow_type(read.schema[c].dataType) for c in names}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(b.schema.names.index("raw_"))
            columns = {c: b.column(b.schema.names.index(c)) for c in names}
            if raw.null_count < len(raw):
                texts = raw.to_pylist()
                for c, f in fix.items():
                    old = columns[c].to_pylist()
                    columns[c] = pa.array([o if t is None else f(t) for o, t in zip(old, texts)], kinds[c])
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return read.mapInArrow(run, T.StructType([read.schema[c] for c in names]))


def response_nodes(df: DataFrame, key: str = "raw_id", column: str = "raw", src: str = "ocr_raw") -> DataFrame:
    """(src, rec_id, node) of elements and their inner records."""
    return nodes(decoded(df.filter(F.col(column).isNotNull()), key, column, shape=True), key, "layout", ["items", "items"], src)
