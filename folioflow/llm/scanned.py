"""Repair of text from scanned pages: furniture, carried-over words, misread characters.

1. Furniture words are those that stand nearly always in the first or last
   lines of a page; a line made of them is a header or footer, a line that is
   only a number is a page number by its form, place and page. The words go to
   the executors as a filter of fixed size.
2. The lexicon counts every word of the corpus. The character editor is
   trained on its most frequent words (LEXICON_SAMPLE of them). Each distinct
   token is joined with the more frequent words of the same strokes, however
   many of its characters were misread; the perceptron scores the labels that
   turn it into the word against keeping it, and the better sequence wins.
3. One pass over the lines emits furniture, carried-over words and tokens that
   may be misread; exact joins with corrections and lexicon follow.

Edge cases: null, empty and blank texts have no defects; repeated rows count
once; an empty table gives an empty result; a hyphen without a continuation
is no defect.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.confusables import consistent
from folioflow.llm.editor import NUMBER, CharEditor, strokes, train
from folioflow.session import cut_lineage

#: Most frequent words the editor is trained on.
LEXICON_SAMPLE = 4000
#: A word that a token may be a form of occurs so often at least.
WORD_LEAST = 3
#: Lines at either end of a page that count as its edge; least share and number there of a furniture word.
EDGE, EDGE_SHARE, EDGE_LEAST = 3, 0.8, 6
#: Bits of the furniture filter (2 MB whatever the number of words) and bits set for an entry.
FURNITURE_BITS, PROBES = 1 << 24, 3
#: Bits of the filter of correctable tokens (1 MB).
TOKEN_BITS = 1 << 23

TAGS = re.compile(r"</?[a-zA-Z][^<>]*>")
TOKEN = re.compile(r"[^\W_]+(?:['./-][^\W_]+)*")
JAVA_TOKEN = r"[\p{L}\p{N}]+(?:['./-][\p{L}\p{N}]+)*"
_STRIP = " \t\r.,;:!?()[]{}|*\"'«»“”©—–-~_"
_MARKS = "-¬‐‑­"
_HEAD = re.compile(rf"([^\W\d_]+(?:[-'][^\W\d_]+)*)[{_MARKS}][ \t]*\Z")
_TAIL = re.compile(r"[ \t]*([^\W\d_]+(?:[-'][^\W\d_]+)*)")
_D = r"[\dlOSBIo]{1,4}"
_PAGENO = re.compile(
    rf"(?:(?P<dash>[-—–~])\s*{_D}\s*(?P=dash)|\[?\(?p\s?[a-z0-9]\s?g\s?[a-z0-9]\s+{_D}(?:\s+[o0-9][f0-9t]\s+{_D})?\)?\]?|p[.,]?\s*{_D}|pg\.?\s*{_D}|{_D}\s*(?:/|of)\s*{_D})\Z",
    re.I,
)
#: What a page number can begin with.
_PAGENO_FIRST = frozenset("-—–~[(pP0123456789lLoOsSbBiI")
_BARE = re.compile(r"\d{1,4}\Z")
#: A coefficient and its variable, unless it stands between words of a sentence.
_TERM = re.compile(r"[2-9][a-km-np-z]\Z|\d\d+[a-km-np-z]\Z")
_WORD_BEFORE, _WORD_AFTER = re.compile(r"[a-z]{2,} \Z"), re.compile(r" [^\W_]")


def texts(pages: DataFrame, parts: DataFrame) -> DataFrame:
    """(src, rec_id, doc_id, page, text) of the three columns."""
    a = pages.select(F.lit("ocr_pages.markdown").alias("src"), F.col("page_id").alias("rec_id"), "doc_id", "page", F.col("markdown").alias("text"))
    return a.unionByName(part_texts(parts)).filter("text is not null")


def part_texts(parts: DataFrame) -> DataFrame:
    both = F.explode(F.array(*[F.struct(F.lit(f"parts.{f}").alias("src"), F.col(f).alias("text")) for f in ("text", "working")])).alias("x")
    return parts.select(F.col("part_id").alias("rec_id"), "doc_id", "page", both).select("x.src", "rec_id", "doc_id", "page", "x.text")


# -- furniture ---------------------------------------------------------------


def furniture_key(word: str) -> str:
    """Lower-case word with digits masked; '' where it has neither a letter nor a slash."""
    w = word.strip(_STRIP).lower()
    if not any(c.isalpha() or c == "/" for c in w):
        return ""
    return re.sub(r"\d", "9", w)


def furniture_words(pages: DataFrame) -> DataFrame:
    """(word) of the words that stand in the edge lines of pages, over all pages: EDGE_LEAST times at least, however many pages there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = (Counter(), Counter())
            for text in b.column(0).to_pylist():
                lines = [x for x in text.split("\n") if x and not x.isspace() and x[0] != "<"]
                n = len(lines)
                middle = lines[EDGE : n - EDGE] if n > 2 * EDGE else []
                raw[0].update(" ".join(lines if n <= 2 * EDGE else lines[:EDGE] + lines[n - EDGE :]).split())
                raw[1].update(" ".join(middle).split())
            counts: dict[str, list[int]] = {}
            for at in (0, 1):
                for w, n in raw[at].items():
                    if k := furniture_key(w):
                        counts.setdefault(k, [0, 0])[at] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([x[0] for x in counts.values()], pa.int64()), pa.array([x[1] for x in counts.values()], pa.int64())], ["word", "at_edge", "inside"])

    markdown = pages.select("markdown").filter("markdown is not null")
    counts = markdown.mapInArrow(run, "word string, at_edge bigint, inside bigint").groupBy("word").agg(F.sum("at_edge").alias("e"), F.sum("inside").alias("i"))
    return counts.filter((F.col("e") >= EDGE_LEAST) & (F.col("e") >= EDGE_SHARE * (F.col("e") + F.col("i")))).select("word")


def furniture_entries(word: str) -> list[str]:
    """What the filter holds of a word: itself, its beginnings (words are cut off at a page's side) and its strokes (misread forms have the same)."""
    out = ["=" + word, *("<" + word[:i] for i in range(4, len(word)))]
    return out if "9" in word or len(word) < 3 else out + ["~" + x for x in strokes(word)]


def _probes(entry: str) -> list[int]:
    h = xxhash.xxh64_intdigest(entry)
    return [(h >> 21 * i) % FURNITURE_BITS for i in range(PROBES)]


def bit_set(positions: DataFrame, bits: int) -> bytes:
    """A set of (at, bit) rows as bytes, gathered as at most bits / 64 words."""
    words = np.zeros(bits // 64, np.int64)
    for r in positions.groupBy("at").agg(F.bit_or("bit").alias("bits")).collect():
        words[r.at] = r.bits
    return words.tobytes()  # little endian: byte h >> 3, bit h & 7


def _at_bits(h: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(h >> 6, pa.int64()), pa.array(np.int64(1) << (h & 63), pa.int64())], ["at", "bit"])


def furniture_filter(words: DataFrame) -> bytes:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _at_bits(np.array([h for w in b.column(0).to_pylist() for x in furniture_entries(w) for h in _probes(x)], np.int64))

    return bit_set(words.select("word").mapInArrow(run, "at bigint, bit bigint"), FURNITURE_BITS)


class Furniture:
    def __init__(self, bits: bytes):
        self.bits = bits
        self.words: dict[str, bool] = {}  # caches, emptied when they are large
        self.known: dict[str, bool] = {}

    def _holds(self, entry: str) -> bool:
        return all(self.bits[h >> 3] >> (h & 7) & 1 for h in _probes(entry))

    def exact(self, key: str) -> bool:
        if key not in self.words:
            if len(self.words) > 200_000:
                self.words.clear()
            self.words[key] = self._holds("=" + key)
        return self.words[key]

    def like(self, word: str) -> bool:
        """A furniture word, one cut off, or a misread form of one."""
        if word not in self.known:
            if len(self.known) > 50_000:
                self.known.clear()
            key, bare = furniture_key(word), word.strip(_STRIP).lower()
            self.known[word] = bool(key) and (self.exact(key) or len(key) >= 4 and self._holds("<" + key) or len(bare) >= 3 and any(self._holds("~" + x) for x in strokes(bare)))
        return self.known[word]

    def header(self, words: list[str]) -> bool:
        keys = [(w, k) for w in words if (k := furniture_key(w))]
        if not any(self.exact(k) or "9999/" in k and self.like(w) for w, k in keys):
            return False
        like = [k for w, k in keys if self.like(w)]
        return sum(map(len, like)) >= 0.7 * sum(len(k) for _, k in keys) and (len(set(like)) >= 2 or "9999/" in like[0])

    def kinds(self, lines: list[str], page: int | None, plain: set[str] = frozenset()) -> list[str]:
        """header, pageno or '' for each line. plain: words known to be no furniture."""
        out, bare = [], []
        for i, line in enumerate(lines):
            kind, n = "", len(line)
            if n > 60 and plain.issuperset(words := line.split()) or not n:
                pass
            elif (s := line.strip()) and s[0] != "<":
                if s[0] in _PAGENO_FIRST and _PAGENO.match(s):
                    kind = "pageno"
                elif not plain.issuperset(words := s.split()) and self.header(words):
                    kind = "header"
                elif len(s) < 5 and _BARE.match(s):
                    bare.append(i)
            out.append(kind)
        for i in bare:
            if page is not None and int(lines[i]) == page + 1 and not self._listed(lines, out, i):
                out[i] = "pageno"
        return out

    @staticmethod
    def _listed(lines: list[str], kinds: list[str], i: int) -> bool:
        """A value of a list in the question: under a colon or other values, and not at an edge or beside furniture."""
        around = [lines[j].strip() if 0 <= j < len(lines) else None for j in (i - 1, i + 1)]
        beside = any(0 <= j < len(lines) and kinds[j] for j in (i - 1, i + 1))
        rest = [x for j, x in enumerate(lines) if x.strip() and not kinds[j] and j != i]
        first = not any(x.strip() and not kinds[j] for j, x in enumerate(lines[:i]))
        last = not any(x.strip() and not kinds[i + 1 + j] for j, x in enumerate(lines[i + 1 :]))
        if not rest or first or last or beside or "" in around or lines[i][:1] == " ":
            return False
        above = around[0] or ""
        return above.endswith(":") or bool(_BARE.match(above)) or bool(_BARE.match(around[1] or ""))


# -- lexicon and corrections --------------------------------------------------


def _key(token: Column) -> Column:
    """Lower case, but for tokens with digits or a capital inside: there the case tells what was misread."""
    return F.when(token.rlike(r"[0-9]|[a-z][A-Z]"), token).otherwise(F.lower(token))


_CASED = re.compile(r"[0-9]|[a-z][A-Z]")


def token_key(token: str) -> str:
    return token if _CASED.search(token) else token.lower()


def lexicon(all_texts: DataFrame) -> DataFrame:
    """(key, n, n_cap): how often each token with a letter stands in the corpus, and how often with a capital first."""
    plain = F.regexp_replace("text", r"</?[a-zA-Z][^<>]*>", " ")
    tokens = all_texts.select(F.explode(F.regexp_extract_all(plain, F.lit(JAVA_TOKEN), F.lit(0))).alias("token"))
    tokens = tokens.groupBy("token").agg(F.count("*").alias("n")).filter(F.col("token").rlike(r"\p{L}"))
    cap = F.when(F.col("token").rlike(r"^\p{Lu}\p{Ll}"), F.col("n")).otherwise(0)
    return tokens.groupBy(_key(F.col("token")).alias("key")).agg(F.sum("n").alias("n"), F.sum(cap).alias("n_cap"))


def fit_editor(words: DataFrame, sample: int = LEXICON_SAMPLE) -> tuple[CharEditor, list[str]]:
    top = words.filter(F.col("key").rlike(r"^[a-z]+(-[a-z]+)?$")).orderBy(F.desc("n"), "key").limit(sample)
    known = [r.key for r in top.collect()]
    return train(known), known


def corrections(words: DataFrame, editor: CharEditor) -> DataFrame:
    """(key, word) of the misread tokens: each joined with the more frequent words of its strokes, then judged by the editor."""
    shared = words.sparkSession.sparkContext.broadcast(editor.w)

    def of_strokes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(i, s) for i, k in enumerate(b.column(0).to_pylist()) for s in strokes(k)]
            at = pa.array([i for i, _ in found], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([s for _, s in found], pa.string()), *(c.take(at) for c in b.columns)], ["strokes", "key", "n", "n_cap"])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = CharEditor(shared.value)
        for b in batches:
            found = [e.judged(k, w, counts) for k, w, *counts in zip(*(c.to_pylist() for c in b.columns))]
            at = [i for i, f in enumerate(found) if f and f[0] > 0]
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(at, pa.int32())) for c in (0, 1)), pa.array([found[i][1] for i in at], pa.float64())], ["key", "word", "rank"])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = CharEditor(shared.value)
        for b in batches:
            keys = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([e.number(k) for k in keys], pa.string())], ["key", "word"])

    # a digit inside tells more than a capital: such a token is no name
    asked = words.filter(F.col("key").rlike("[A-Za-z]")).select("key", "n", F.when(F.col("key").rlike("[0-9]"), 0).otherwise(F.col("n_cap")).alias("n_cap"))
    number = F.col("key").rlike(NUMBER)
    numbers = asked.filter(number).select("key").mapInArrow(decoded, "key string, word string").filter("key <> word").select("key", F.lower("word").alias("word"), F.lit(0.0).alias("rank"))
    spelled = asked.filter(~number & (F.length("key") > 1)).mapInArrow(of_strokes, "strokes string, key string, n bigint, n_cap bigint")
    w = spelled.filter(F.col("n") >= WORD_LEAST).select("strokes", F.lower("key").alias("word"), F.col("n").alias("n_w"), F.col("n_cap").alias("cap_w"))
    pairs = spelled.join(w, "strokes").filter((F.col("n_w") > F.col("n")) & (F.lower("key") != F.col("word"))).select("key", "word", "n", "n_cap", "n_w", "cap_w").distinct()
    lexical = pairs.mapInArrow(judged, "key string, word string, rank double")
    return numbers.unionByName(lexical).groupBy("key").agg(F.max_by("word", F.struct("rank", "word")).alias("word"))


def token_filter(keys: DataFrame, bits: int = TOKEN_BITS) -> bytes:
    """A bit set of the hashed keys, of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _at_bits(np.array([zlib.crc32(k.encode()) & (bits - 1) for k in b.column(0).to_pylist()], np.int64))

    return bit_set(keys.select("key").mapInArrow(run, "at bigint, bit bigint"), bits)


# -- the pass over the lines ----------------------------------------------------


def raw_lines(text: str) -> list[str]:
    """The lines in their consistent form; a soft hyphen at a line end is a mark, not an invisible sign."""
    if not text.isascii():
        if "\xad" in text:
            text = re.sub(r"\xad(?=[ \t\r]*(?:\n|\Z))", "¬", text)
        text = consistent(text)
    return text.split("\n")


def without_tags(raw: list[str]) -> list[str]:
    return [TAGS.sub(" ", x) if "<" in x else x for x in raw]


@dataclass
class Reader:
    """What the pass needs on every executor; all of it of bounded size."""

    furniture: bytes
    common: frozenset[str] = frozenset()
    bits: bytes = b""
    mask: int = 0
    f: Furniture = field(init=False)

    def __post_init__(self):
        self.f = Furniture(self.furniture)
        #: Words as they stand, punctuation included, that are neither furniture nor suspect. A cache, emptied when it is large.
        self.plain: set[str] = set()

    def maybe(self, key: str) -> bool:
        h = zlib.crc32(key.encode()) & self.mask
        return bool(self.bits[h >> 3] >> (h & 7) & 1)

    def suspect(self, token: str) -> str:
        """The key of a token that may be misread, else ''."""
        if token in self.common:
            return ""
        k = token_key(token)
        return k if k not in self.common and self.maybe(k) else ""

    def learn(self, words: list[str]) -> bool:
        """Whether all words are plain."""
        if len(self.plain) > 300_000:
            self.plain.clear()
        new = [w for w in words if w not in self.plain]
        good = [w for w in new if not self.f.exact(k := furniture_key(w)) and "9999/" not in k and not any(self.suspect(t) for t in TOKEN.findall(w))]
        self.plain.update(good)
        return len(good) == len(new)

    def lines(self, text: str, page: int | None) -> tuple[list[str], list[str]]:
        """The lines in their consistent form without tags, and their kinds."""
        raw = raw_lines(text)
        return without_tags(raw), self.f.kinds(raw, page, self.plain)

    def scan(self, text: str, page: int | None) -> list[tuple[int, str, str, str]]:
        """(line number, kind, a, b): header and pageno; hyphen (head, tail); first (tail, '' if no word begins it) and last (head) of the text; token."""
        lines, kinds = self.lines(text, page)
        out: list[tuple[int, str, str, str]] = []
        open_: tuple[int, str] | None = None
        seen = False
        for no, (line, kind) in enumerate(zip(lines, kinds), 1):
            if kind:
                out.append((no, kind, "", ""))
                continue
            if not line or line.isspace():
                continue
            begin = 0
            if open_ or not seen:
                m = _TAIL.match(line)
                if open_ and m and (m[1][0].islower() or open_[1].isupper()):
                    out.append((open_[0], "hyphen", open_[1], m[1]))
                    begin = m.end()
                elif not seen:
                    out.append((no, "first", "", m[1] if m else ""))
            seen = True
            open_ = None
            end = len(line)
            if line.rstrip()[-1:] in _MARKS and (m := _HEAD.search(line)):
                open_ = (no, m[1])
                end = m.start()
            words = line[begin:end].split()
            if self.plain.issuperset(words) or self.learn(words):
                continue
            for m in TOKEN.finditer(line, begin, end):
                k = self.suspect(m[0])
                if not k or _TERM.match(k) and (line.count("$", 0, m.start()) % 2 or not _WORD_BEFORE.search(line, 0, m.start()) or not _WORD_AFTER.match(line, m.end())):
                    continue
                out.append((no, "token", k, ""))
        if open_:
            out.append((open_[0], "last", open_[1], ""))
        return out


def _scanned(all_texts: DataFrame, reader: Reader) -> DataFrame:
    shared = all_texts.sparkSession.sparkContext.broadcast((reader.furniture, reader.common, reader.bits, reader.mask))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = Reader(*shared.value)
        for b in batches:
            at, no, kind, x, y = [], [], [], [], []
            for i, (page, text) in enumerate(zip(b.column(3).to_pylist(), b.column(4).to_pylist())):
                for n, k, s, t in r.scan(text, page):
                    at.append(i)
                    no.append(n)
                    kind.append(k)
                    x.append(s)
                    y.append(t)
            at_ = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(at_) for c in range(4)), pa.array(no, pa.int32()), pa.array(kind, pa.string()), pa.array(x, pa.string()), pa.array(y, pa.string())], ["src", "rec_id", "doc_id", "page", "line_no", "kind", "a", "b"])

    schema = "src string, rec_id bigint, doc_id string, page int, line_no int, kind string, a string, b string"
    return all_texts.select("src", "rec_id", "doc_id", "page", "text").mapInArrow(run, schema)


@dataclass
class Model:
    """Fitted on the corpus: furniture words, editor, lexicon and corrections (both distributed)."""

    reader: Reader
    editor: CharEditor
    words: DataFrame
    fixes: DataFrame


def fit(all_texts: DataFrame, pages: DataFrame) -> Model:
    words = cut_lineage(lexicon(all_texts))
    editor, known = fit_editor(words)
    fixes = cut_lineage(corrections(words, editor))
    bad = {r.key for r in fixes.filter(F.col("key").isin(known)).collect()} if known else set()  # at most the sample
    bits = token_filter(fixes)
    common = frozenset(k for k in known if k not in bad)
    return Model(Reader(furniture_filter(furniture_words(pages)), common, bits, TOKEN_BITS - 1), editor, words, fixes)


def whole_words(pieces: DataFrame, model: Model) -> DataFrame:
    """pieces with a (head) and b (tail) get `word`: the editor decides whether the hyphen stays, knowing how often the lexicon has either form."""
    pairs = pieces.select(F.lower("a").alias("a"), F.lower("b").alias("b")).distinct()
    n = model.words.select("key", "n")
    shared = pieces.sparkSession.sparkContext.broadcast(model.editor.w)

    @F.arrow_udf("boolean")
    def keeps(a: pa.Array, b: pa.Array, n_j: pa.Array, n_h: pa.Array) -> pa.Array:
        e = CharEditor(shared.value)
        return pa.array([e.joins_with_hyphen(*x) for x in zip(*(c.to_pylist() for c in (a, b, n_j, n_h)))], pa.bool_())

    with_n = (
        pairs.withColumn("j", F.concat("a", "b")).withColumn("h", F.concat_ws("-", "a", "b"))
        .join(n.select(F.col("key").alias("j"), F.col("n").alias("n_j")), "j", "left")
        .join(n.select(F.col("key").alias("h"), F.col("n").alias("n_h")), "h", "left")
        .join(model.fixes.select(F.col("key").alias("j"), F.col("word").alias("fixed")), "j", "left")
    )
    n_j, n_h = F.coalesce("n_j", F.lit(0)), F.coalesce("n_h", F.lit(0))
    word = F.when(F.col("keeps"), F.col("h")).otherwise(F.coalesce("fixed", "j"))
    decided = with_n.withColumn("keeps", keeps("a", "b", n_j, n_h)).select("a", "b", word.alias("word"))
    return pieces.withColumn("la", F.lower("a")).withColumn("lb", F.lower("b")).join(decided.select(F.col("a").alias("la"), F.col("b").alias("lb"), "word"), ["la", "lb"])


def detail(all_texts: DataFrame, model: Model) -> DataFrame:
    """(src, rec_id, line_no, kind, a, b, word): defects with what stands on the page (a, at a line end also b).

    kind `tail` is the rest of a word carried over from the page before; it is
    no defect of its own line.
    """
    rows = cut_lineage(_scanned(all_texts, model.reader).distinct())
    cols = ("src", "rec_id", "line_no", "kind", "a", "b", "word")
    plain = rows.filter("kind in ('header', 'pageno')").withColumn("word", F.lit("")).select(*cols)
    # a word carried over to the document's next page that has text: pages missing, blank or of furniture only lie between
    last = rows.filter("kind = 'last' and src = 'ocr_pages.markdown'")
    first = rows.filter("kind = 'first' and src = 'ocr_pages.markdown' and page is not null").select("doc_id", F.col("page").alias("next_page"), F.col("b").alias("next"), F.col("rec_id").alias("next_id"), F.col("line_no").alias("next_no"))
    page = F.col("next_page")
    follows = first.select("doc_id", "next_page").distinct().select("doc_id", page.alias("page"), F.lead(page).over(Window.partitionBy("doc_id").orderBy(page)).alias("next_page"))
    over = last.join(follows, ["doc_id", "page"]).join(first, ["doc_id", "next_page"]).filter("next <> ''").filter((F.lower(F.substring("next", 1, 1)) == F.substring("next", 1, 1)) | (F.upper("a") == F.col("a")))
    pieces = rows.filter("kind = 'hyphen'").select("src", "rec_id", "line_no", "a", "b")
    pieces = pieces.unionByName(over.select("src", "rec_id", "line_no", "a", F.col("next").alias("b")))
    hyphens = whole_words(pieces, model).withColumn("kind", F.lit("hyphen")).select(*cols)
    tails = over.select("src", F.col("next_id").alias("rec_id"), F.col("next_no").alias("line_no"), F.lit("tail").alias("kind"), F.lit("").alias("a"), F.col("next").alias("b"), F.lit("").alias("word"))
    tokens = rows.filter("kind = 'token'").drop("kind").withColumn("kind", F.lit("char"))
    chars = tokens.join(model.fixes.withColumnRenamed("key", "a"), "a").select(*cols)
    return plain.unionByName(hyphens).unionByName(tails).unionByName(chars)


def defects(pages: DataFrame, parts: DataFrame) -> DataFrame:
    """(src, rec_id, line_no, kind, word): one row for each defect."""
    all_texts = texts(pages, parts)
    found = detail(all_texts, fit(all_texts, pages)).filter("kind <> 'tail'")
    return found.select("src", "rec_id", "line_no", "kind", "word").distinct()


# -- the repaired text ------------------------------------------------------------


def _like(word: str, seen: str) -> str:
    if seen.isupper() and len(seen) > 1:
        return word.upper()
    return word[:1].upper() + word[1:] if seen[:1].isupper() else word


def rebuild(lines: list[str], edits: list[dict]) -> str:
    """The lines as printed: furniture dropped, words whole, wrapped lines joined to paragraphs."""
    gone, fix, carried, cut = set(), {}, {}, {}
    for e in edits:
        n, kind = e["line_no"], e["kind"]
        if kind in ("header", "pageno"):
            gone.add(n)
        elif kind == "char":
            fix.setdefault(n, {})[e["a"]] = e["word"]
        elif kind == "hyphen":
            carried[n] = e["word"]
        else:
            cut[n] = e["b"]
    kept = [(n, x) for n, x in enumerate(lines, 1) if n not in gone]
    width = max((len(x.rstrip()) for _, x in kept), default=0)
    out: list[str] = []
    glue, word = "", None
    for n, line in kept:
        if not line.strip():
            if out and word is None and glue != " ":
                glue = "\n\n"
            elif word is None and out and re.search(r"[.?!:\]$}]\s*\Z", out[-1]):
                glue = "\n\n"
            continue
        if n in cut and word is None:
            line = re.sub(r"\A\s*" + re.escape(cut[n]), "", line)
        if word is not None and (m := _TAIL.match(line)):
            line, word = word + line[m.end() :], None
            glue = " " if glue == "\n\n" else glue or " "
        full = len(line.rstrip()) >= 0.8 * width
        if n in carried and (m := _HEAD.search(line)):
            line, word = line[: m.start()].rstrip(), _like(carried[n], m[1])
        if n in fix:
            f = fix[n]
            line = TOKEN.sub(lambda m: _like(f[k], m[0]) if (k := token_key(m[0])) in f else m[0], line)
        out.append(glue + line.strip() if out else line.strip())
        glue = " " if full or word is not None else "\n"
    if word is not None:
        out.append(" " + word if out else word)
    return "".join(out)


def repaired(all_texts: DataFrame, model: Model, then: Callable[[pa.Array, pa.Array, list], pa.RecordBatch] | None = None, schema: str = "src string, rec_id bigint, text string") -> DataFrame:
    """(src, rec_id, text): each text as continuous paragraphs; repeated rows once. Null and empty texts stay as they are.

    then: what is made of a batch (src, rec_id, texts) in the same Python process, rows of `schema`; a process of its own would double the workers.
    """
    edit = F.struct("line_no", "kind", "a", "b", "word").alias("e")
    by_text = detail(all_texts.filter("text is not null"), model).groupBy("src", "rec_id").agg(F.collect_list(edit).alias("edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, edits in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                if text and (edits or "\n" in text or "<" in text or not text.isascii()):
                    text = rebuild(without_tags(raw_lines(text)), edits or [])
                out.append(text)
            yield then(b.column(0), b.column(1), out) if then else pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], ["src", "rec_id", "text"])

    joined = all_texts.dropDuplicates(["src", "rec_id"]).join(by_text, ["src", "rec_id"], "left").select("src", "rec_id", "text", "edits")
    return joined.mapInArrow(run, schema)
