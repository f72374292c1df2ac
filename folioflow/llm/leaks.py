"""Evaluation texts inside training texts, also in pieces, reordered or re-parameterised.

Template canonicalisation: numbers, names and units become typed placeholders,
so that a template window is found whatever fills its slots. The windows of
the items are joined by hash with those of the documents; then the words
themselves, slots included, are compared along the hits, for every pair that
has one: a piece counts if it holds a window of equal templates. `leaks` counts the
words actually held. `refilled` gives the pairs that reach the share only if
slots filled otherwise count too, where equal values of the item stand for
equal values of the document.

Edge cases: null and empty texts hold nothing; an item without words is never
found, one of few words by a shorter window; repeated rows count once; an
empty item table gives no rows.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from math import ceil
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.confusables import consistent
from folioflow.session import cut_lineage

#: Words of a template window; words of a piece at least; share of the item's words that must be found.
WINDOW, PIECE, SHARE = 5, 10, 0.5
#: Equal words that must follow a changed one inside a piece; plain words that a window of typed slots needs.
ASIDE, ANCHORS = 3, 2
#: Tasks among which the documents of one window are split.
SALT = 8
#: Characters of all items up to which their table is broadcast.
BROADCAST_CHARS = 8_000_000
#: Bits of the filter of the items' window hashes (1 MB whatever the number of items).
BITS = 1 << 23
_MARKUP = re.compile(r"</?[a-zA-Z][^<>]*>|&[a-z]+;")
#: Units of measure of the exam texts' subject.
UNITS = frozenset(
    "metre metres centimetre centimetres millimetre millimetres kilometre kilometres gram grams kilogram kilograms tonne tonnes litre litres millilitre millilitres "
    "second seconds minute minutes hour hours day days week weeks month months year years newton newtons joule joules volt volts watt watts amp amps ohm ohms degree degrees "
    "crown crowns dollar dollars pound pounds euro euros cent cents percent".split()
)


@lru_cache(maxsize=200_000)
def _token(w: str) -> tuple[str, str]:
    """The folded word and its kind: n, u, - for a plain word, ^ for a capitalised one that may be a name."""
    low = w.lower()
    if not low.isascii():
        low = "".join(c for c in unicodedata.normalize("NFKD", low) if not unicodedata.combining(c))
    if any(c.isdigit() for c in low):
        return low, "n"
    if low in UNITS:
        return low, "u"
    return low, "^" if w[0].isupper() and not w.isupper() else "-"


_OPENING = r"[\s\"'«“(\[*_-]*"
#: A word and, if it begins a sentence, what stands before it.
_TOKEN = re.compile(rf"([.?!:;>$]{_OPENING}|\n\s*\n{_OPENING})?([^\W_]+)")


def words_and_kinds(text: str) -> tuple[list[str], str]:
    """The runs of letters or digits, folded, and a character for each: n (number), p (name) or u (unit) for a slot, - for a plain word.

    A capitalised word that doesn't begin a sentence is a name.
    """
    found = _TOKEN.findall(consistent(_MARKUP.sub(" ", text)) if "<" in text or "&" in text else consistent(text))
    pairs = [_token(w) for _, w in found]
    kinds = "".join([k for _, k in pairs])
    if "^" in kinds:
        kinds = kinds[0].replace("^", "-") + kinds[1:]  # the first word of all begins a sentence
        kinds = "".join([k if k != "^" else "-" if before else "p" for k, (before, _) in zip(kinds, found)])
    return [w for w, _ in pairs], kinds


def tokens(text: str) -> list[tuple[str, str]]:
    """(word, template): the template of a slot is its type."""
    return [(w, w if k == "-" else "#" + k) for w, k in zip(*words_and_kinds(text))]


@lru_cache(maxsize=200_000)
def _hash(template: str) -> int:
    return zlib.crc32(template.encode())


def window_hashes(words: list[str], kinds: str, w: int = WINDOW) -> np.ndarray:
    """64-bit hashes of the windows of w words, built from one hash per word.

    A slot counts by its type, but where a window has fewer than ANCHORS plain
    words by its value: a row of numbers would else be equal to any other.
    """
    n = len(words) - w + 1
    if n <= 0:
        return np.empty(0, np.int64)
    own = np.fromiter(map(_hash, words), np.uint64, len(words))
    slot = np.frombuffer(kinds.encode(), np.uint8)
    plain = slot == ord("-")
    typed = np.where(plain, own, slot)
    out = [np.full(n, w, np.uint64), np.full(n, w, np.uint64)]
    for k, h in enumerate((typed, own)):
        for i in range(w):
            out[k] = (out[k] ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            out[k] ^= out[k] >> np.uint64(31)
    before = np.concatenate([[0], np.cumsum(plain)])
    return np.where(before[w:] - before[:-w] >= min(ANCHORS, w), out[0], ~out[1]).view(np.int64)


def window_size(n: int, share: float = SHARE) -> int:
    """The window for an item of n words: WINDOW, less where the passage to be found is so short that one changed word would break every such window."""
    least = max(1, ceil(share * n))
    return least if least < 3 else min(WINDOW, ceil((least - 1) / 2))


def _close(a: str, b: str) -> bool:
    """Equal, or one changed, added or lost character."""
    if a == b:
        return True
    n, m = len(a), len(b)
    if abs(n - m) > 1 or min(n, m) < 3:
        return False
    i = 0
    while i < min(n, m) and a[i] == b[i]:
        i += 1
    return a[i + (n >= m) :] == b[i + (m >= n) :]


def slot_values(doc: list[str], item: list[str], kinds: tuple[str, str], diagonals: list[int]) -> dict[tuple[str, str], str]:
    """(kind, item's value) -> the document's value that most of its slots in equal template windows have; of equally many the first in order.

    A value of the item stands for one value of the document only; slots filled otherwise are changed words.
    """
    votes: dict[tuple[str, str], Counter] = {}
    for d in diagonals:
        lo, hi = max(0, -d), min(len(item), len(doc) - d)
        same = [kinds[0][i + d] == kinds[1][i] and (kinds[1][i] != "-" or doc[i + d] == item[i]) for i in range(lo, hi)]
        inside = {i + k for i in range(len(same) - WINDOW + 1) if all(same[i : i + WINDOW]) for k in range(WINDOW)}
        for i in (lo + x for x in inside):
            if kinds[1][i] != "-":
                votes.setdefault((kinds[1][i], item[i]), Counter())[doc[i + d]] += 1
    return {k: min(v, key=lambda w: (-v[w], w)) for k, v in votes.items()}


def matched(doc: list[str], item: list[str], diagonals: list[int], piece: int = PIECE, kinds: tuple[str, str] | None = None, share: float = SHARE) -> int:
    """How many of the item's words stand in the document, in pieces of at least `piece` words, or in one that is enough by itself.

    diagonals: place in the document less place in the item, of equal windows.
    Where less than half of the words needed are equal letter for letter,
    nothing is held. Along each diagonal the words are compared; inside a piece single words may
    be changed, and one may be added or lost where the piece goes on.
    kinds: the slots of document and item; with them a consistently refilled slot counts as held.
    """
    spans = [(d, max(0, -d), min(len(item), len(doc) - d)) for d in diagonals]
    alike = 0
    for d, lo, hi in spans:
        alike += sum(map(eq, doc[lo + d : hi + d], item[lo:hi]))
        if kinds:
            alike += sum(kinds[1][i] != "-" and kinds[0][i + d] == kinds[1][i] and doc[i + d] != item[i] for i in range(lo, hi))
    if 2 * alike < share * len(item):
        return 0
    values = slot_values(doc, item, kinds, diagonals) if kinds else {}
    runs = []
    for d, lo, hi in spans:
        ok = [x == y or _close(x, y) for x, y in zip(doc[lo + d : hi + d], item[lo:hi])]
        if kinds:  # a slot counts by its value's one counterpart
            for i in range(lo, hi):
                if kinds[1][i] != "-" and kinds[0][i + d] == kinds[1][i] and (kinds[1][i], item[i]) in values:
                    ok[i - lo] = values[kinds[1][i], item[i]] == doc[i + d]
        i = 0
        while i < len(ok):
            if not ok[i]:
                i += 1
                continue
            j = straight = i
            while True:
                while j < len(ok) and ok[j]:
                    j += 1
                # one changed word, with enough equal ones on either side
                if j - straight >= min(ASIDE, j - i) and j - straight >= 2 and j + ASIDE < len(ok) and all(ok[j + 1 : j + 1 + ASIDE]):
                    straight = j = j + 1
                else:
                    break
            runs.append((lo + i, lo + j, d, sum(ok[i:j])))
            i = j
    # pieces that go on after one word more or less
    runs.sort()
    joined = True
    while joined:
        joined = False
        for x in range(len(runs)):
            for y in range(len(runs)):
                a, b, d, n = runs[x]
                s, e, f, m = runs[y]
                if x != y and abs(d - f) == 1 and a < s and b < e and -1 <= s - b <= 1 and min(n, m) >= 3:
                    over = max(0, b - s)
                    runs[x] = (a, e, f, n + m - over)
                    del runs[y]
                    joined = True
                    break
            if joined:
                break
    covered = set()
    for a, b, _, n in runs:
        if b - a >= piece or n >= share * len(item):
            covered.update(range(a, b))
    return len(covered)


def item_windows(items: DataFrame, share: float = SHARE) -> DataFrame:
    """(hash, item_id, at, size) of the template windows of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words, kinds = words_and_kinds(text)
                if words:
                    w = window_size(len(words), share)
                    h = window_hashes(words, kinds, w)
                    n = len(h)
                    yield pa.RecordBatch.from_arrays([pa.array(h), pa.array([i] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32)), pa.array([w] * n, pa.int32())], ["hash", "item_id", "at", "size"])

    texts = items.select("item_id", "text").filter("text is not null").distinct()
    return texts.mapInArrow(run, "hash bigint, item_id bigint, at int, size int")


def _filter(windows: DataFrame) -> np.ndarray:
    words = np.zeros(BITS // 64, np.int64)
    low = F.col("hash").bitwiseAND(F.lit(BITS - 1))
    rows = windows.select(F.shiftright(low, 6).alias("at"), F.expr("shiftleft(1L, cast(hash & 63 as int))").alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).collect()
    for r in rows:  # at most BITS / 64
        words[r.at] = r.bits
    return words


def document_hits(documents: DataFrame, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """(doc_id, words, kinds, hashes, places) of the documents with windows that an item may have. sizes: the window lengths in use, WINDOW at most."""
    shared = documents.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in batches if sizes else ():
            read = [words_and_kinds(text) for text in b.column(1).to_pylist()]
            own, of = [x for x, _ in read], [x for _, x in read]
            # the windows of all texts of the batch at once; those that reach into the next text go
            n = np.fromiter(map(len, own), np.int64, len(own))
            doc, ends = np.repeat(np.arange(len(own)), n), np.cumsum(n)
            all_words, all_kinds = list(chain.from_iterable(own)), "".join(of)
            found, where = [], []
            for size in sizes:
                h = window_hashes(all_words, all_kinds, size)
                low = h & (BITS - 1)
                at = np.flatnonzero((w[low >> 6] >> (low & 63)) & 1)
                at = at[at + size <= ends[doc[at]]]
                found.append(h[at])
                where.append(at)
            at = np.concatenate(where)
            order = np.argsort(doc[at], kind="stable")
            at, hashes = at[order], np.concatenate(found)[order]
            keep, counts = np.unique(doc[at], return_counts=True)
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            places = pa.array(at - (ends - n)[doc[at]], pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, x) for x in (pa.array(hashes), places)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep)), pa.array([" ".join(own[i]) for i in keep], pa.string()), pa.array([of[i] for i in keep], pa.string()), *lists], ["doc_id", "words", "kinds", "hashes", "places"])

    texts = documents.select("doc_id", "text").filter("text <> ''")
    return texts.mapInArrow(run, "doc_id bigint, words string, kinds string, hashes array<bigint>, places array<int>")


def leaks(documents: DataFrame, items: DataFrame, share: float = SHARE, piece: int = PIECE) -> DataFrame:
    """(doc_id, item_id): the document holds at least `share` of the item's words."""
    return _pairs(documents, items, share, piece, False)


def refilled(documents: DataFrame, items: DataFrame, share: float = SHARE, piece: int = PIECE) -> DataFrame:
    """(doc_id, item_id): the document holds at least `share` of the item's words only if consistently refilled slots count."""
    return _pairs(documents, items, share, piece, True)


def compared(documents: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, diagonals, words, kinds, item): every pair with an equal window.

    A window that many documents have is split: its documents go to SALT
    tasks, and the items' windows, which are few, to all of them. Only the
    diagonals of a pair are gathered, at most one per word of either side.
    """
    windows = cut_lineage(item_windows(items, share))
    sizes = sorted(r.size for r in windows.select("size").distinct().collect())  # at most WINDOW
    docs = cut_lineage(document_hits(documents, _filter(windows), sizes))
    hits = docs.select("doc_id", F.explode(F.arrays_zip("hashes", "places")).alias("h")).select("doc_id", F.col("h.hashes").alias("hash"), F.col("h.places").alias("place"), F.pmod("doc_id", F.lit(SALT)).cast("int").alias("salt"))
    salted = windows.select("hash", "item_id", "at", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    near = hits.join(salted, ["hash", "salt"]).groupBy("doc_id", "item_id").agg(F.collect_set(F.col("place") - F.col("at")).alias("diagonals"))
    texts = items.select("item_id", F.col("text").alias("item")).filter("text is not null").distinct()
    words = docs.select("doc_id", "words", "kinds")
    small = (texts.agg(F.sum(F.length("item")).alias("n")).first().n or 0) <= BROADCAST_CHARS
    # a large table of items goes to the pairs before they are wide
    wide = near.join(words, "doc_id").join(F.broadcast(texts), "item_id") if small else near.join(texts, "item_id").join(words, "doc_id")
    return wide.select("doc_id", "item_id", "diagonals", "words", "kinds", "item")


def _pairs(documents: DataFrame, items: DataFrame, share: float, piece: int, refill: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = lru_cache(maxsize=10_000)(words_and_kinds)
        last, doc = None, []
        for b in batches:
            keep = []
            for i, (diagonals, text, of, item) in enumerate(zip(*(b.column(c).to_pylist() for c in range(2, 6)))):
                words, kinds = read(item)
                if text != last:  # the pairs of a document come one after another
                    last, doc = text, text.split(" ")
                least = share * len(words)
                held = matched(doc, words, diagonals, piece, share=share) >= least
                if refill:
                    held = not held and matched(doc, words, diagonals, piece, (of, kinds), share) >= least
                if held:
                    keep.append(i)
            at = pa.array(keep, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at)], ["doc_id", "item_id"])

    return compared(documents, items, share).mapInArrow(run, "doc_id bigint, item_id bigint").distinct()
