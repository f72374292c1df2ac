"""File names out of references, whatever path, case or characters they are written with."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Cyrillic and Greek letters drawn like a Latin one.
LOOKALIKES = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "ո": "n", "о": "o",
    "р": "p", "ԛ": "q", "ѕ": "s", "ս": "u", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O",
    "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "Ү": "Y", "У": "Y", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W",
    "ο": "o", "ν": "v", "α": "a", "ρ": "p", "ι": "i", "υ": "u", "κ": "k", "χ": "x", "γ": "y", "ϲ": "c", "ϳ": "j",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C",
}
#: Latin letters of other shapes that are drawn like a plain one.
LATIN_SHAPES = {"ɑ": "a", "ɡ": "g", "ı": "i", "ɩ": "i", "ʏ": "y", "ſ": "s", "ɪ": "i", "ᴄ": "c", "ᴏ": "o", "ᴜ": "u", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z"}


def _invisible() -> list[str]:
    """Format characters and other default-ignorable code points of the basic plane."""
    more = [0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x3164, 0xFFA0, *range(0xFE00, 0xFE10)]
    return [chr(c) for c in range(0x10000) if unicodedata.category(chr(c)) == "Cf" and not 0x0600 <= c <= 0x08FF] + [chr(c) for c in more]


def _forms() -> dict[str, str]:
    """Characters of the basic plane whose compatibility form is one printable ASCII character."""
    out = {}
    for c in range(0xA0, 0x10000):
        ch = chr(c)
        if unicodedata.decomposition(ch).startswith(("<super>", "<sub>")):
            continue
        n = unicodedata.normalize("NFKC", ch)
        if len(n) == 1 and 32 <= ord(n) < 127:
            out[ch] = n
    return out


INVISIBLE = _invisible()
_FOLD = {**_forms(), **LOOKALIKES, **LATIN_SHAPES}
_FROM = "".join(_FOLD) + "".join(INVISIBLE)
_TO = "".join(_FOLD.values())


def fold_ascii(c: Column) -> Column:
    """Look-alikes and other forms become ASCII, invisible characters go (JVM side, one pass)."""
    return F.translate(c, _FROM, _TO)


def _decoded(c: Column) -> Column:
    """Percent escapes undone; text that is no valid escape sequence stays. The lambda names c once, so nesting doesn't copy it."""
    decode = lambda x: F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), x)
    return F.element_at(F.transform(F.array(c), decode), 1)


def file_key(c: Column) -> Column:
    """Lower-case file name of a path or address.

    Query and fragment are cut, escapes undone (also when written twice),
    `/`, `\\` and `:` end a folder. Null stays null; nothing left gives ''.
    """
    c = F.regexp_replace(F.trim(c), r"[?#].*$", "")
    c = fold_ascii(_decoded(_decoded(c)))
    c = F.regexp_replace(c, r"^\s+|[\s/\\]+$", "")
    return F.lower(F.trim(F.regexp_replace(c, r"^.*[/\\:]", "")))
