"""JSON of OCR responses as typed columns, by Spark's own parser.

The layout stands under one of two names wherever the envelope keeps it, and
the envelope, or a piece of it, can be a string of JSON. Objects are searched
level by level, fields by name. DEPTH levels are searched in the expression;
`deep` tells of a text that goes on below, for which there is another way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioflow.functions.text import let

#: Names of the layout, the text, and of an element's label, content and box, each in order of preference.
LAYOUT, MARKDOWN, LABEL, CONTENT, BOX, INNER_TEXT = ("layout_details", "layout"), ("md_results", "markdown", "md"), ("label", "type"), ("content", "text"), ("bbox_2d", "bbox", "box"), ("t", "text")
#: Levels of envelopes, and of lists in lists, that the expressions go down.
DEPTH = 8
_VARIANTS = "array<variant>"
CORNERS = ("x0", "y0", "x1", "y1")


def _array(v: Column) -> Column:
    return F.try_variant_get(v, "$", _VARIANTS)


def _map(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _string(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _none() -> Column:
    return F.array().cast(_VARIANTS)


def _field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def _list(v: Column) -> Column:
    """A list, also one written as a string of JSON."""
    return F.coalesce(_array(v), F.when(_map(v).isNull(), _array(F.try_parse_json(_string(v)))))


def own_layout(v: Column) -> Column:
    return F.coalesce(*[_list(_field(v, n)) for n in LAYOUT])


def text_of(v: Column, names: tuple[str, ...]) -> Column:
    """The first of the fields that is a string and not empty."""
    own = lambda x: F.when((F.schema_of_variant(x) == "STRING") & (_string(x) != ""), _string(x))
    return F.coalesce(*[own(_field(v, n)) for n in names])


def _children(v: Column) -> Column:
    text = _string(v)
    read = F.when(text.rlike(r'^\s*[{\["]'), F.array(F.try_parse_json(text)))
    return F.filter(F.coalesce(F.map_values(_map(v)), _array(v), read, _none()), lambda x: x.isNotNull())


def found(raw: Column, wanted: Callable[[Column], Column]) -> Column:
    """struct<at: array<variant>, deep>: the first object that is wanted, in a list of one; deep where the search has to go on below."""
    start = F.struct(F.filter(F.array(F.try_parse_json(raw)), lambda x: x.isNotNull()).alias("open"), _none().alias("at"))

    def step(acc: Column, _: Column) -> Column:
        hits = let(F.slice(F.filter(acc["open"], wanted), 1, 1), lambda h: F.struct(F.when(F.size(h) > 0, _none()).otherwise(F.flatten(F.transform(acc["open"], _children))).alias("open"), h.alias("at")))
        return F.when(F.size(acc["open"]) > 0, hits).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(1), F.lit(DEPTH)), start, step, lambda a: F.struct(a["at"].alias("at"), (F.size(a["open"]) > 0).alias("deep")))


def layout(raw: Column) -> Column:
    """struct<elements: array<variant>, deep>: the element objects, those of inner lists included, in order."""

    def flat(acc: Column, _: Column) -> Column:
        inner = F.flatten(F.transform(acc, lambda x: F.coalesce(_array(x), F.array(x))))
        return F.when(F.exists(acc, lambda x: _array(x).isNotNull()), F.filter(inner, lambda x: x.isNotNull())).otherwise(acc)

    def spread(a: Column) -> Column:
        own = F.coalesce(F.flatten(F.transform(a["at"], own_layout)), _none())
        lists = F.aggregate(F.sequence(F.lit(1), F.lit(DEPTH)), F.filter(own, lambda x: x.isNotNull()), flat)
        return let(lists, lambda x: F.struct(F.filter(x, lambda y: _map(y).isNotNull()).alias("elements"), (a["deep"] | F.exists(x, lambda y: _array(y).isNotNull())).alias("deep")))

    return let(found(raw, lambda v: own_layout(v).isNotNull()), spread)


def _record_list(m: Column) -> Column:
    """struct<key, objects> of the one list of objects among the fields; null without one."""
    lists = F.transform(F.map_entries(m), lambda e: F.struct(e["key"].alias("key"), F.filter(F.coalesce(_array(e["value"]), _none()), lambda x: _map(x).isNotNull()).alias("objects")))
    return F.try_element_at(F.filter(lists, lambda e: F.size(e["objects"]) > 0), F.lit(1))


def _attributes(m: Column, left_out: Column) -> Column:
    """The other fields as texts."""
    return F.transform_values(F.map_filter(m, lambda k, v: ~k.eqNullSafe(left_out) & v.isNotNull()), lambda k, v: _string(v))


def _box(v: Column) -> Column:
    return F.coalesce(*[F.try_variant_get(v, f"$.{n}", "array<double>") for n in BOX])


def _with_list(v: Column, use: Callable[[Column, Column], Column]) -> Column:
    """use(fields, list of objects or null)."""
    return let(_map(v), lambda m: let(_record_list(m), lambda r: use(m, r)))


def elements(objects: Column) -> Column:
    """The typed layout: array<struct<label, content, x0, y0, x1, y1, list_name, attrs, items>>."""
    leaf = lambda v: F.struct(text_of(v, INNER_TEXT).alias("text"), _attributes(_map(v), F.lit(None).cast("string")).alias("attrs"))

    def item(v: Column) -> Column:
        return _with_list(v, lambda m, r: F.struct(text_of(v, INNER_TEXT).alias("text"), r["key"].alias("list_name"), _attributes(m, r["key"]).alias("attrs"), F.transform(F.coalesce(r["objects"], _none()), leaf).alias("items")))

    def element(v: Column) -> Column:
        corners = lambda b: [F.get(b, F.lit(i)).alias(n) for i, n in enumerate(CORNERS)]
        return _with_list(v, lambda m, r: F.struct(
            text_of(v, LABEL).alias("label"), text_of(v, CONTENT).alias("content"), *corners(_box(v)), r["key"].alias("list_name"),
            _attributes(m, r["key"]).alias("attrs"), F.transform(F.coalesce(r["objects"], _none()), item).alias("items"),
        ))

    return F.transform(objects, element)


def shapes(objects: Column) -> Column:
    """The typed layout without its contents: array<struct<items: array<struct<items: array<boolean>>>>>."""
    inner = lambda v, use: F.transform(F.coalesce(_record_list(_map(v))["objects"], _none()), use)
    leaves = lambda v: F.struct(inner(v, lambda _: F.lit(True)).alias("items"))
    return F.transform(objects, lambda v: F.struct(inner(v, leaves).alias("items")))


def boxed_elements(objects: Column) -> Column:
    """The elements with a box of four numbers, as pages have them; a missing label is `text`."""
    numbers = F.transform(objects, lambda v: F.struct(v.alias("v"), _box(v).alias("b")))
    whole = F.filter(numbers, lambda x: (F.size(x["b"]) == 4) & ~F.exists(x["b"], lambda n: n.isNull()))
    box = lambda b: F.struct(*[F.get(b, F.lit(i)).alias(n) for i, n in enumerate(CORNERS)])
    return F.transform(whole, lambda x: F.struct(F.coalesce(text_of(x["v"], LABEL), F.lit("text")).alias("label"), box(x["b"]).alias("bbox"), text_of(x["v"], CONTENT).alias("content")))


def markdown(raw: Column) -> Column:
    """struct<text, deep>: the text of the first object that has one or a layout."""
    has = lambda v: text_of(v, MARKDOWN).isNotNull() | own_layout(v).isNotNull()
    return let(found(raw, has), lambda a: F.struct(F.coalesce(F.try_element_at(F.transform(a["at"], lambda v: text_of(v, MARKDOWN)), F.lit(1)), F.lit("")).alias("text"), a["deep"].alias("deep")))
