"""Language of documents and of the segments of mixed ones, by cross-parsing.

For each language a suffix automaton holds the labelled text. A sentence is
parsed into the longest phrases that stand in that text; the language that
needs the fewest phrases, normalised by length, wins. The confidence is
fitted on held-out labelled passages: how often such a lead was right. Neighbouring sentences
of one language form a segment. Sentences without letters to judge by, and
short ones that are undecided, follow their neighbours.

Edge cases: null, blank and word-free texts have no language and no segment;
repeated rows count once; without labelled text there are no languages and no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.session import each_once

#: Characters of labelled text per language that the automata are built from; samples are taken in a fixed order.
SAMPLE_CHARS = 40_000
#: A sentence counts by itself from so many letters and with such a lead; else its neighbours decide.
SURE_LETTERS, SURE_LEAD = 20, 0.08
#: Parts of the labelled text that are held out in turn, and the lengths in words of the passages whose leads the confidence is fitted on.
FOLDS, PASSAGES = 3, (1, 2, 3, 5, 8, 13)

#: Languages and the notations that name them (codes, English and own names).
NAMES = {
    "en": "en eng english anglais englisch inglés inglês английский",
    "fr": "fr fra fre french français francais französisch francés francês французский",
    "de": "de deu ger german deutsch allemand alemán alemão немецкий",
    "es": "es spa spanish español espanol castellano espagnol spanisch espanhol испанский",
    "pt": "pt por portuguese português portugues portugais portugiesisch portugués португальский",
    "ru": "ru rus russian русский russe russisch ruso russo",
}
#: Labels that name no language.
NO_NAME = frozenset("und unknown mul zxx mis n/a na none null ?? ? - -- xx other unk undefined tbd nan not".split()) | {""}
_BY_NAME = {n: code for code, names in NAMES.items() for n in names.split()}


def label_code(label: str | None) -> str | None:
    """The language a label names: one of the codes above, other text as it is, None where it names none."""
    s = (label or "").strip().lower().replace("_", "-")
    if s in NO_NAME:
        return None
    s = re.sub(r"\s*\(.*\)$", "", s)
    main = s.split("-")[0].strip()
    return _BY_NAME.get(s) or _BY_NAME.get(main) or (None if main in NO_NAME else s)


# -- suffix automaton -------------------------------------------------------------


class Automaton:
    """All substrings of a text of codes below `symbols`; `phrases` counts the greedy longest-match parses of many others at once.

    One array holds, for each state and symbol, twice the state that follows
    plus one where a new phrase begins there.
    """

    def __init__(self, text: Sequence[int], symbols: int):
        nxt: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(nxt)
                    nxt.append(dict(nxt[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and nxt[p].get(c) == q:
                        nxt[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        #: The state after a symbol that the text doesn't have: whatever follows begins a phrase. Parses start there.
        self.lost, self.symbols = len(nxt), symbols
        root = np.full(symbols, self.lost, np.int32)
        root[list(nxt[0])] = list(nxt[0].values())
        self.go = np.tile(root * 2 + 1, (len(nxt) + 1, 1))
        for i, state in enumerate(nxt):
            self.go[i, list(state)] = np.fromiter(state.values(), np.int32, len(state)) * 2
        self.go[:, 0] = self.lost * 2 + 1  # a character that is no symbol stands in no phrase
        self.go = self.go.ravel()

    def phrases(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The number of phrases of each text codes[start : start + length]. All are read in step, one symbol at a time, the longest first in order."""
        order = np.argsort(-lengths, kind="stable")
        at, left = starts[order], lengths[order]
        state = np.full(len(at), self.lost, np.int32)
        out = np.zeros(len(at), np.int32)
        for i in range(int(left[0]) if len(left) else 0):
            n = int(np.searchsorted(-left, -i, "left"))  # texts longer than i
            got = self.go[state[:n] * self.symbols + codes[at[:n] + i]]
            out[:n] += got & 1
            state[:n] = got >> 1
        back = np.empty_like(out)
        back[order] = out
        return back


_SIGNS = re.compile(r"\$[^$]*\$|\\[a-zA-Z]+|https?://\S+")
_NOT_TEXT = re.compile(r"[^\w'¿¡?!]+|[\d_]+")


def plain(s: str) -> str:
    """Lower-case words with single spaces, formulas and numbers dropped."""
    s = _SIGNS.sub(" ", s)
    return " " + " ".join(_NOT_TEXT.sub(" ", s.lower()).split()) + " "


_ACCENTS = str.maketrans("áàâãäåçéèêëíìîïñóòôõöúùûüýÿßœæ", "aaaaaaceeeeiiiinooooouuuuyysoa")
#: The symbols texts are parsed in; any other character is one more.
SYMBOLS = " abcdefghijklmnopqrstuvwxyz'?!¿¡" + "абвгдежзийклмнопрстуфхцчшщъыьэюяё"


class _Codes(dict):
    """Character to code: accents go, as some texts lost theirs."""

    def __init__(self):
        super().__init__({ord(c): i for i, c in enumerate(SYMBOLS, 1)})
        self.update({k: self[ord(chr(v) if isinstance(v, int) else v)] for k, v in _ACCENTS.items()})

    def __missing__(self, c: int) -> int:
        return 0


_CODES = _Codes()


def codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).translate(_CODES).encode("latin-1"), np.uint8)


def evidence(lead: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """What the confidence grows with: the lead, worth more in a longer text."""
    return np.asarray(lead) * np.sqrt(np.asarray(letters))


def calibrated(samples: dict[str, str]) -> tuple[float, float]:
    """(a, b) of the confidence 1 / (1 + exp(-a - b x)), x the evidence.

    Fitted on labelled passages of PASSAGES words, each judged by automata of
    the other FOLDS - 1 parts of the text. One wrong and one right passage
    without evidence are added, so that it never reaches 1.
    """
    x, right = [0.0, 0.0], [0.0, 1.0]
    for fold in range(FOLDS):
        lines = {k: v.split("\n") for k, v in samples.items()}
        judge = Judge({k: "\n".join(s for i, s in enumerate(v) if i % FOLDS != fold) for k, v in lines.items()})
        for k, v in lines.items():
            words = [plain(s).split() for s in v[fold::FOLDS]]
            held = [" " + " ".join(w[i : i + n]) + " " for w in words for n in PASSAGES for i in range(0, len(w) - n + 1, max(n, len(w) // 3))]
            if held:
                rates = judge.rates(held)
                order = np.sort(rates, axis=1)
                second = order[:, min(1, rates.shape[1] - 1)]
                x += evidence((second - order[:, 0]) / np.maximum(second, 1e-9), [len(h) - h.count(" ") for h in held]).tolist()
                right += (rates.argmin(axis=1) == judge.langs.index(k)).astype(float).tolist()
    design, y, w = np.stack([np.ones(len(x)), x], axis=1), np.array(right), np.zeros(2)
    for _ in range(25):  # Newton steps, lightly regularised
        p = 1 / (1 + np.exp(-design @ w))
        w += np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2), design.T @ (y - p) - 0.01 * w)
    return float(w[0]), float(max(w[1], 0.0))


class Judge:
    """Parses with the automaton of each language of the text's alphabet, every one to its end."""

    def __init__(self, samples: dict[str, str]):
        self.langs = sorted(samples)
        self.of = {k: Automaton(codes([plain(v)]).tolist(), len(SYMBOLS) + 1) for k, v in samples.items()}
        self.cyrillic = np.array([_mostly_cyrillic(samples[k]) for k in self.langs])
        self.sure = (0.0, 1.0)

    def confidence(self, lead: float, letters: int) -> float:
        """How likely the language is right."""
        a, b = self.sure
        return float(1 / (1 + np.exp(-a - b * evidence(lead, letters))))

    def rates(self, texts: list[str]) -> np.ndarray:
        """Phrases per character, a row per text (plain) and a column per language; 1 for a language of another alphabet."""
        out = np.ones((len(texts), len(self.langs)))
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        symbols = codes(texts)
        starts = np.cumsum(lengths) - lengths
        cyrillic = np.array([_mostly_cyrillic(x) for x in texts], bool)
        for j, k in enumerate(self.langs):
            of = np.flatnonzero(cyrillic == self.cyrillic[j])
            out[of, j] = self.of[k].phrases(symbols, starts[of], lengths[of]) / np.maximum(1, lengths[of] - 2)
        return out


@lru_cache(maxsize=2)
def judge_of(samples: tuple[tuple[str, str], ...], sure: tuple[float, float]) -> Judge:
    """Built once per worker."""
    judge = Judge(dict(samples))
    judge.sure = sure
    return judge


def _mostly_cyrillic(s: str) -> bool:
    if s.isascii():
        return False
    letters = sum(c.isalpha() for c in s)
    return sum("а" <= c <= "я" or c == "ё" for c in s.lower()) > 0.5 * letters


_END = re.compile(r"(?<=[.!?…])[\"'»”)\]]*\s+(?=[^a-zа-яß\s])|\n\s*\n|(?<=[.!?:;\]])[ \t]*\n")
_ITEM = re.compile(r"\s*(?:\d{1,3}[.)]|[-*•]|\(\w{1,3}\))\s+")


def sentences(text: str) -> list[str]:
    """The sentences of a text in order. A line break inside a sentence does not end it; numbering at its start goes."""
    text = re.sub(r"(?m)^[ \t]*(?:\d{1,3}[.)]|[-*•])[ \t]+", "\n\n", text)
    text = re.sub(r"[ \t]*\[\d{1,3}\][ \t]*(?=\n|\Z)", "\n\n", text)
    return [s for s in (x.strip() for x in _END.split(text)) if s]


def judged(texts: list[str], judge: Judge) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
    """The sentences of each text, and for all sentences in order their letters and rates. Equal sentences of a batch are parsed once."""
    of = [sentences(t) for t in texts]
    bare = [plain(s) for ss in of for s in ss]
    letters = np.array([len(s) - s.count(" ") for s in bare], np.int64)
    number: dict[str, int] = {}
    at = np.array([number.setdefault(s, len(number)) for s in bare], np.int64)
    return of, letters, judge.rates(list(number))[at]


def segments(texts: list[str], judge: Judge) -> list[list[tuple[str, str, float, int]]]:
    """(language, text, confidence, letters) of the longest stretches of sentences in one language, for each text."""
    of, letters, rates = judged(texts, judge)
    if not len(letters):
        return [[] for _ in of]
    order = np.sort(rates, axis=1)
    best = rates.argmin(axis=1)  # the first in order of equal ones
    second = order[:, min(1, rates.shape[1] - 1)]
    lead = np.where(letters < 2, 0.0, (second - order[:, 0]) / np.maximum(second, 1e-9) if rates.shape[1] > 1 else 1.0)
    out, end = [], 0
    for ss in of:
        rows = slice(end, end + len(ss))
        end += len(ss)
        out.append(_stretches(ss, judge, letters[rows], rates[rows], best[rows], lead[rows]))
    return out


def _stretches(ss: list[str], judge: Judge, letters: np.ndarray, rates: np.ndarray, best: np.ndarray, lead: np.ndarray) -> list[tuple[str, str, float, int]]:
    if not (letters >= 2).any():
        return []
    sure = (letters >= SURE_LETTERS) & (lead >= SURE_LEAD)
    own: list[int | None] = [int(k) if n >= 2 else None for k, n in zip(best, letters)]
    langs: list[int | None] = [int(k) if s else None for k, s in zip(best, sure)]
    if not sure.any():
        told = letters >= 2
        langs = [int((rates[told] * letters[told, None]).sum(axis=0).argmin())] * len(ss)
    before: list[int | None] = []
    for k in langs:
        before.append(k if k is not None else before[-1] if before else None)
    after = langs[:]
    for i in range(len(langs) - 2, -1, -1):
        if after[i] is None:
            after[i] = after[i + 1]
    out: list[list] = []
    for i, s in enumerate(ss):
        k = langs[i]
        if k is None:
            # a sentence that can't tell follows a neighbour, the one of its own guess first
            k = own[i] if own[i] is not None and own[i] in (before[i], after[i]) else before[i] if before[i] is not None else after[i]
        if out and out[-1][0] == k:
            out[-1][1].append(s)
        else:
            out.append([k, [s], 0.0, 0])
        out[-1][2] += float(lead[i] * letters[i])
        out[-1][3] += int(letters[i])
    return [(judge.langs[k], " ".join(x), judge.confidence(t / max(n, 1), n), n) for k, x, t, n in out]


# -- operators ----------------------------------------------------------------------


def training_text(samples: DataFrame, chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """Labelled text per language, at most `chars` characters of each: the bounded sample the automata are fitted on."""
    rows = samples.filter("text is not null and lang is not null").select("sample_id", "lang", "text").distinct()
    ahead = F.sum(F.length("text")).over(_by_language())
    out: dict[str, list[str]] = {}
    for r in rows.withColumn("upto", ahead).filter(F.col("upto") <= chars).orderBy("sample_id").collect():
        if code := label_code(r.lang):
            out.setdefault(code, []).append(r.text)
    return {k: "\n".join(v) for k, v in out.items()}


def _by_language():
    from pyspark.sql import Window

    return Window.partitionBy("lang").orderBy("sample_id")


def document_segments(documents: DataFrame, samples: DataFrame) -> DataFrame:
    """(doc_id, label, code, seg_no, lang, confidence, letters, text) of every document with words."""
    labelled = training_text(samples)
    shared = documents.sparkSession.sparkContext.broadcast((tuple(sorted(labelled.items())), calibrated(labelled) if labelled else (0.0, 1.0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = judge_of(*shared.value)
        for b in batches:
            rows = []
            ids, labels, texts = (c.to_pylist() for c in b.columns)
            for i, label, found in zip(ids, labels, segments(texts, judge) if judge.langs else [[]] * len(ids)):
                code = label_code(label)
                for no, (k, s, sure, n) in enumerate(found, 1):
                    rows.append((i, label, code, no, k, sure, n, s))
            cols = list(zip(*rows)) if rows else [[]] * 8
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["doc_id", "label", "code", "seg_no", "lang", "confidence", "letters", "text"])

    texts = each_once(documents.select("doc_id", F.col("lang").alias("label"), "text").filter("text is not null"), "doc_id")
    return texts.mapInArrow(run, "doc_id bigint, label string, code string, seg_no int, lang string, confidence double, letters int, text string")


def needs_label(segments_: DataFrame) -> DataFrame:
    """The segments of documents whose label is missing or wrong or that have more than one language.

    Decided inside each document by its first segment and its number of segments.
    """
    one = segments_.groupBy("doc_id").agg(F.count("*").alias("n"), F.min_by("lang", "seg_no").alias("first"), F.first("code").alias("c"))
    bad = one.filter((F.col("n") > 1) | F.col("c").isNull() | (F.col("c") != F.col("first"))).select("doc_id")
    return segments_.join(bad, "doc_id", "left_semi")
