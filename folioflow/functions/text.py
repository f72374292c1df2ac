"""Text functions of pages, lines and question parts, as column expressions."""

from __future__ import annotations

import html.entities
import json
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns the results depend on.
FRONT_MATTER = r"(?i)CANDIDATE NAME|BLANK PAGE"
MARKER_LINE = r"^\$?\s*!\[\]\(page=\d+(?:,bbox=\[[^\]]*\])?\)\s*\$?$"
FOOTER_LINE = r"(?i)Cambridge University Press|\[Turn over\]|Licensed for hosting|Trace ID"
MARKS = r"(?i)\[\d{1,2}\]|\(\d{1,2}\s*marks?\)|\b\d{1,2}\s*marks?\b"
LEADING_NUMBER = r"^\s*(?:\[.*?\]\s*)?\(?\d{1,2}\b"
PUBLISHER = "Cambridge University Press"
_BREAK = "\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085  ]"
#: White space inside a line.
WS = r"[\s&&[^\r\n]]"
_NUMBERED = rf"{WS}*(?:Q(?:uestion)?{WS}*)?(\d{{1,2}})\b"
_LABEL = rf"{WS}*\(?([a-z]|\b(?:i{{1,3}}|iv|v)\b){WS}*\)"
_CUT = "\u001d"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), value worked out once however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip(c: Column) -> Column:
    """All white space off both ends (trim takes spaces only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def lstrip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+", "")


def lines(c: Column) -> Column:
    """The lines of a text; a line break at the end opens no further line."""
    parts = F.split(c, _BREAK, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def joined(a: Column) -> Column:
    return F.array_join(a, "\n")


def blank(c: Column) -> Column:
    return c.isNull() | ~c.rlike(r"(?U)\S")


def is_front_matter(c: Column) -> Column:
    return c.rlike(FRONT_MATTER)


def is_junk(line: Column) -> Column:
    return strip(line).rlike(MARKER_LINE) | line.rlike(FOOTER_LINE)


def clean_junk(c: Column) -> Column:
    """Without placeholder-image and footer lines."""
    return joined(F.filter(lines(c), lambda x: ~is_junk(x)))


def meaningful_length(c: Column) -> Column:
    """Characters of a page that carry content: no blank, image or publisher lines."""
    kept = F.filter(lines(c), lambda x: ~blank(x) & ~F.startswith(strip(x), F.lit("![")) & ~F.contains(x, F.lit(PUBLISHER)))
    return F.length(strip(F.array_join(kept, "")))


def sparse_fallback(c: Column, rebuilt: Column, least: int = 20) -> Column:
    """The rebuilt text where a page has next to no content and the rebuilt text has."""
    return F.when((meaningful_length(c) < least) & (F.length(strip(rebuilt)) >= least), rebuilt).otherwise(c)


def first_mark(c: Column) -> Column:
    """The leftmost mark: [N], (N marks) or N marks; null where there is none."""
    return F.try_to_number(F.nullif(F.regexp_extract(F.regexp_extract(c, MARKS, 0), r"\d{1,2}", 0), F.lit("")), F.lit("99")).cast("int")


def question_number(part_id: Column) -> Column:
    return F.nullif(F.regexp_extract(part_id, r"^\d{1,2}", 0), F.lit(""))


def is_stem(part_id: Column) -> Column:
    return part_id.rlike(r"^\d{1,2}$")


def starts_numbered(c: Column) -> Column:
    """Any line opens a question."""
    return c.rlike(rf"(?imU)^{_NUMBERED}")


def inject_number(c: Column, numbers: Column) -> Column:
    """The topmost of numbers (n, y) before a text that lacks its question number.

    Blank texts, front matter, texts that have a number and an empty list of
    numbers leave the text as it is.
    """
    top = F.element_at(F.array_sort(F.transform(numbers, lambda x, i: F.struct(x["y"].alias("y"), i.alias("i"), x["n"].alias("n")))), 1)["n"]
    rows = lines(lstrip(c))
    first = F.array_position(F.transform(rows, lambda x: ~(is_junk(x) | blank(x))), True)
    rest = lstrip(joined(F.slice(rows, F.greatest(first, F.lit(1)).cast("int"), F.size(rows))))
    same = (F.size(numbers) == 0) | blank(c) | is_front_matter(c) | (first == 0) | rest.rlike(LEADING_NUMBER)
    return F.when(F.coalesce(same, F.lit(True)), c).otherwise(F.concat(top.cast("string"), F.lit(". "), rest))


def carry_prefix(c: Column, number: Column) -> Column:
    """A continuation page gets the number of the question it continues."""
    needs = number.isNotNull() & ~blank(c) & ~starts_numbered(c)
    return F.when(needs, F.concat_ws(" ", number, lstrip(c))).otherwise(c)


def _opened(c: Column, opener: str) -> Column:
    """The text without its opener, the first line stripped, then the whole."""
    rest = F.regexp_replace(c, rf"(?iU)^{opener}", "")
    return strip(F.regexp_replace(rest, rf"(?U)^({WS}*)([^\r\n]*?){WS}*(\r?\n|\z)", "$2$3"))


def question_blocks(c: Column) -> Column:
    """array<struct<number, text>>: a line that opens with a number begins a block; what stands before the first is left out."""
    cut = F.split(F.regexp_replace(c, rf"(?imU)^(?={_NUMBERED})", _CUT), _CUT, -1)
    own = F.slice(cut, 2, F.size(cut))
    return F.transform(
        own,
        lambda x: F.struct(
            F.regexp_extract(x, rf"(?iU)^{_NUMBERED}", 1).alias("number"),
            _opened(x, rf"{_NUMBERED}(?:{WS}|[.)])*").alias("text"),
        ),
    )


def block_parts(number: Column, text: Column) -> Column:
    """array<struct<id, marks, text>>: lettered parts of a block, what stands before the first label as its stem."""
    cut = F.split(F.regexp_replace(text, rf"(?imU)^(?={_LABEL})", _CUT), _CUT, -1)
    own = F.filter(cut, lambda x: x != "")

    def part(x: Column) -> Column:
        label = F.lower(F.regexp_extract(x, rf"(?iU)^{_LABEL}", 1))
        body = _opened(x, rf"{_LABEL}{WS}*")
        pid = F.when(label == "", number).otherwise(F.concat(number, F.lit("("), label, F.lit(")")))
        return F.struct(pid.alias("id"), F.when(label == "", strip(x)).otherwise(body).alias("text"))

    parts = F.transform(own, part)
    return F.transform(parts, lambda p: F.struct(p["id"].alias("id"), first_mark(p["text"]).alias("marks"), p["text"].alias("text")))


def prose_parts(c: Column) -> Column:
    """array<struct<id, marks, text>> of a page's prose, in order."""
    return F.flatten(F.transform(question_blocks(c), lambda b: block_parts(b["number"], b["text"])))


# -- names, documents, escapes -------------------------------------------------

#: File-name codes and their meaning.
SERIES = {"s": "May/June", "w": "Oct/Nov", "m": "Feb/March"}
KINDS = {"ms": "marking_scheme", "qp": "question_paper", "in": "insert"}
_NAME = r"(?i)(\d{4})[_-]([smw]\d{2})[_-](ms|qp|in)[_-](\d{2})"
#: File suffixes and their media types.
MEDIA_TYPES = {".json": "application/json", ".md": "text/markdown", ".txt": "text/plain", ".png": "image/png", ".jpg": "image/jpeg", ".pdf": "application/pdf", ".html": "text/html"}


def _lookup(values: dict[str, str], key: Column, default: str) -> Column:
    table = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    return F.coalesce(F.try_element_at(table, key), F.lit(default))


def parse_filename(name: Column) -> Column:
    """struct<subject, series, kind, paper, variant>; a foreign name gives blanks, kind `unknown` and a null variant."""
    g = lambda i: F.regexp_extract(name, _NAME, i)
    hit = name.rlike(_NAME)
    code = F.lower(g(2))
    series = F.concat_ws(" ", _lookup(SERIES, F.substring(code, 1, 1), ""), F.concat(F.lit("20"), F.substring(code, 2, 2)))
    blank_ = F.lit("")
    return F.struct(
        g(1).alias("subject"),
        F.when(hit, series).otherwise(blank_).alias("series"),
        F.when(hit, _lookup(KINDS, F.lower(g(3)), "unknown")).otherwise("unknown").alias("kind"),
        F.when(hit, F.concat_ws("/", g(1), g(4))).otherwise(blank_).alias("paper"),
        F.when(hit, g(4)).alias("variant"),
    )


def safe_stem(name: Column) -> Column:
    """File name without folders and suffix, spaces as underscores."""
    base = F.regexp_replace(name, r"^.*[/\\]", "")
    return F.replace(F.regexp_replace(base, r"(?<=.)\.[^.]*$", ""), F.lit(" "), F.lit("_"))


def asset_name(stem: Column, page: Column, n: Column) -> Column:
    return F.format_string("%s_p%d_fig%d.png", stem, page, n)


def media_type(name: Column) -> Column:
    return _lookup(MEDIA_TYPES, F.lower(F.regexp_extract(name, r"[^/\\](\.[^./\\]*)$", 1)), "application/octet-stream")


def data_url(content: Column, kind: str = "image/png") -> Column:
    return F.concat(F.lit(f"data:{kind};base64,"), F.base64(content))


def cache_key(*parts: Column) -> Column:
    """SHA-1 over the parts as text, each ended by a NUL; a null part counts as `None`."""
    return F.sha1(F.concat(*[F.concat(F.coalesce(p.cast("string"), F.lit("None")), F.lit("\u0000")) for p in parts]))


def html_escape(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _from_code_point(n: Column) -> Column:
    """The character of a code point; null where there is none."""
    there = (n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    return F.when(there, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))


def unescape(c: Column) -> Column:
    """Character references resolved, named ones by HTML's own table; what is no reference stays."""
    named = F.from_json(F.lit(json.dumps({k[:-1]: v for k, v in html.entities.html5.items() if k.endswith(";")})), "map<string,string>")
    reference = r"^&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"

    def resolved(x: Column, name: Column) -> Column:
        number = F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10)).when(F.startswith(name, F.lit("#")), F.substr(name, F.lit(2))).try_cast("bigint")
        own = F.coalesce(F.when(number.isNotNull(), _from_code_point(number)), F.try_element_at(named, name))
        return let(own, lambda y: F.when(y.isNull(), x).otherwise(F.concat(y, F.substr(x, F.length(name) + 3))))

    def every(x: Column) -> Column:
        pieces = F.split(x, r"(?=&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);)", -1)
        return F.array_join(F.transform(pieces, lambda y: let(F.regexp_extract(y, reference, 1), lambda name: resolved(y, name))), "")

    def usual(x: Column) -> Column:
        return let(F.replace(F.replace(F.replace(x, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&quot;"), F.lit('"')), lambda y: F.when(y.contains("&"), every(x)).otherwise(y))

    return let(c, lambda x: F.when(x.contains("&"), usual(x)).otherwise(x))
