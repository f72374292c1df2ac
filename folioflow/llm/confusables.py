"""One consistent form for text that looks the same but differs in its characters.

Skeleton of a text: decompose, replace every character by the prototype of the
look-alike table, decompose again. The tokens of all values with equal
skeletons form a group; the consistent forms of a group are the composed forms
of its members in one script. A value is found if it holds a token that is no
consistent form of its group. A word written wholly in foreign letters that
all have Latin doubles is decided by the group of its word: it is a disguise
if the corpus writes that skeleton in Latin more often.

Edge cases: null and empty values have no row; line breaks, genuine accented
letters, whole Greek or Cyrillic words, superscripts, quotation marks and
mathematical signs stay; repeated rows count once.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions.names import INVISIBLE, LATIN_SHAPES, LOOKALIKES
from folioflow.session import cut_lineage

_FORMS = ("<wide>", "<narrow>", "<noBreak>", "<font>", "<compat>", "<circle>", "<square>")
#: Greek letters of Latin shape that nobody uses as a symbol.
NO_SYMBOL = set("οΟΑΒΕΖΗΙΚΜΝΤϲϳϹ")
_TO_CYRILLIC = {v: k for k, v in LOOKALIKES.items() if "а" <= k <= "я" or "А" <= k <= "Я"}
_WORD = re.compile(r"[^\W\d_]+")


@lru_cache(maxsize=1)
def usual_forms() -> dict[int, str]:
    """Character to its usual form, built by rule: invisible to nothing, spaces to a space, compatibility forms to what they stand for."""
    out = {ord(c): "" for c in INVISIBLE}
    out |= {c: "" for c in range(0xE0000, 0xE0080)}
    for c in [*range(0xA0, 0x10000), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F200)]:
        ch = chr(c)
        if c in out or ch in LOOKALIKES:
            continue
        if unicodedata.category(ch) == "Zs":
            out[c] = " "
            continue
        tag = unicodedata.decomposition(ch).split(" ")[0]
        if tag in _FORMS:
            n = unicodedata.normalize("NFKC", ch)
            if all(x.isalnum() or x == " " for x in n) or (tag in ("<wide>", "<narrow>") and len(n) == 1):
                out[c] = n
    out[0x2011] = "-"
    return out


def prototype_table() -> dict[int, str]:
    return {**usual_forms(), **{ord(k): v for k, v in LOOKALIKES.items()}, **{ord(k): v for k, v in LATIN_SHAPES.items()}}


_PROTOTYPES: dict[int, str] = {}


def skeleton(s: str) -> str:
    if s.isascii():
        return s
    if not _PROTOTYPES:
        _PROTOTYPES.update(prototype_table())
    return unicodedata.normalize("NFD", unicodedata.normalize("NFD", s).translate(_PROTOTYPES))


@lru_cache(maxsize=65536)
def _script(ch: str) -> str:
    name = unicodedata.name(ch, "")
    return next((s for s in ("LATIN", "CYRILLIC", "GREEK") if name.startswith(s)), "")


def _one_script(word: str) -> str:
    """The word in the script it belongs to; a mixture that makes no word stays."""
    scripts = {_script(c) for c in word}
    if "LATIN" in scripts and any(c in LATIN_SHAPES for c in word):
        word = "".join(LATIN_SHAPES.get(c, c) for c in word)
    foreign = scripts & {"CYRILLIC", "GREEK"}
    if not foreign or ("LATIN" not in scripts and len(foreign) == 1):
        return word
    if all(c in LOOKALIKES for c in word if _script(c) in foreign):
        return "".join(LOOKALIKES.get(c, c) for c in word)
    if "CYRILLIC" in foreign and all(c in _TO_CYRILLIC or _script(c) == "CYRILLIC" for c in word):
        return "".join(c if _script(c) == "CYRILLIC" else _TO_CYRILLIC[c] for c in word)
    return word


#: Words with a letter that another script or shape may have lent.
_ODD_WORD = re.compile(rf"[^\W\d_]*[{''.join(LATIN_SHAPES)}\u0370-\u03ff\u0400-\u052f\u0561-\u0587][^\W\d_]*")


@lru_cache(maxsize=65536)
def _nature(ch: str) -> int:
    """0: needs nothing; 1: a letter whose word must be looked at; 2: the text must be mapped and composed."""
    if ch.isascii():
        return 0
    if ord(ch) in usual_forms() or unicodedata.combining(ch) or unicodedata.normalize("NFC", ch) != ch:
        return 2
    return 1 if _ODD_WORD.match(ch) else 0


def consistent(s: str) -> str:
    """The consistent form, but for words wholly in foreign letters (see open_words)."""
    if s.isascii():
        return s
    nature = max(map(_nature, set(s)))
    if nature == 2:
        s = unicodedata.normalize("NFC", s.translate(usual_forms()))
    return _ODD_WORD.sub(lambda m: _one_script(m[0]), s) if nature else s


def open_words(s: str) -> list[str]:
    """Words of foreign letters only whose skeleton is Latin; their group decides."""
    out = []
    for w in _WORD.findall(s):
        if not w.isascii() and all(c in LOOKALIKES for c in w):
            greek = _script(w[0]) == "GREEK"
            if not (greek and len(w) == 1 and w not in NO_SYMBOL):
                out.append(w)
    return out


def long_values(parts: DataFrame, fields: tuple[str, ...] = ("text", "answer", "notes"), key: str = "part_id") -> DataFrame:
    """(part_id, field, value) of the non-null values, repeated rows once."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("x")
    return parts.select(key, pairs).select(key, "x.field", "x.value").filter("value is not null")


#: What ends a token; other kinds of white space are characters to be judged.
_SPACE = r"[ \t\r\n]+"


def odd_tokens(values: DataFrame, key: str) -> DataFrame:
    """(key, field, token) of the distinct tokens with characters beyond ASCII of each value."""
    tokens = F.filter(F.array_distinct(F.split("value", _SPACE)), lambda x: x.rlike(r"[^\x00-\x7F]"))
    return values.filter(F.col("value").rlike(r"[^\x00-\x7F]")).select(key, "field", F.explode(tokens).alias("token"))


def token_forms(tokens: DataFrame) -> DataFrame:
    """(token, n, skeleton, form, open, word_skeletons) of the distinct tokens: the form in one script, and the words of it that only their group can decide."""
    counts = tokens.groupBy("token").agg(F.count("*").alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(0).to_pylist()
            forms = [consistent(s) for s in texts]
            open_ = [open_words(c) for c in forms]
            strings = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(list(map(skeleton, texts)), pa.string()), pa.array(forms, pa.string()), pa.array([[w.lower() for w in o] for o in open_], strings), pa.array([[skeleton(w).lower() for w in o] for o in open_], strings)],
                ["token", "n", "skeleton", "form", "open", "word_skeletons"],
            )

    return counts.mapInArrow(run, "token string, n bigint, skeleton string, form string, open array<string>, word_skeletons array<string>")


def latin_counts(values: DataFrame) -> DataFrame:
    """(skeleton, n_latin): how often the corpus writes each Latin word, over all values."""
    words = values.select(F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]+"), F.lit(0))).alias("skeleton"))
    return words.groupBy("skeleton").agg(F.count("*").alias("n_latin"))


def found(parts: DataFrame, key: str = "part_id", fields: tuple[str, ...] = ("text", "answer", "notes")) -> DataFrame:
    """(part_id, field) of the values that hold a token that is no consistent form of its skeleton's group."""
    values = long_values(parts, fields, key)
    tokens = odd_tokens(values, key).distinct()
    forms = cut_lineage(token_forms(tokens))
    # the forms of a group are few: its tokens in one script, composed
    groups_ = forms.groupBy("skeleton").agg(F.collect_set("form").alias("forms"))
    odd = forms.join(groups_, "skeleton").filter(~F.array_contains("forms", F.col("token"))).select("token")
    words = forms.select("token", "n", F.explode(F.arrays_zip("open", "word_skeletons")).alias("x")).select("token", "n", F.col("x.open").alias("word"), F.col("x.word_skeletons").alias("skeleton"))
    written = words.groupBy("word", "skeleton").agg(F.sum("n").alias("n_form"))
    disguised = written.join(latin_counts(values), "skeleton").filter("n_latin > n_form").select("word")
    bad = odd.unionByName(words.join(disguised, "word", "left_semi").select("token")).distinct()
    return tokens.join(bad, "token", "left_semi").select(key, "field").distinct()


def groups(parts: DataFrame, key: str = "part_id", fields: tuple[str, ...] = ("text", "answer", "notes")) -> DataFrame:
    """Values grouped by equal skeleton: (field, skeleton, forms, n) where more than one form occurs.

    Equal forms are counted before the groups are built, so a group holds each
    form once. ASCII values are their own skeleton.
    """
    values = long_values(parts, fields, key).distinct()
    counts = values.groupBy("field", "value").agg(F.count("*").alias("n"))

    @F.arrow_udf("string")
    def skeletons(values: pa.Array) -> pa.Array:
        return pa.array([s and skeleton(s) for s in values.to_pylist()], pa.string())

    ascii_ = counts.filter(~F.col("value").rlike(r"[^\x00-\x7F]")).withColumn("skeleton", F.col("value"))
    other = counts.filter(F.col("value").rlike(r"[^\x00-\x7F]")).withColumn("skeleton", skeletons("value"))
    by = ascii_.unionByName(other).groupBy("field", F.sha2("skeleton", 256).alias("group_id"))
    return by.agg(F.count("*").alias("forms"), F.sum("n").alias("n"), F.max_by("value", F.struct("n", "value")).alias("most_usual")).filter("forms > 1")
