"""Averaged-perceptron character editor: keep, replace, delete, insert and line-join operations.

Every character of a token gets a label: K (keep), R:x (replace), R:x+I:y
(replace and insert), D (delete, after a replacement). A misreading such as
`rn` for `m` is the edit r->R:m, n->D. At a line end the labels are J (join,
the hyphen goes), H (join, the hyphen stays).

A token and a word can be forms of one another only if they are written with
the same strokes. The labels of a token for a word are found by aligning the
two; the perceptron scores them against keeping every character, with features
of the characters around and of how often token and word occur, and the better
sequence wins. Numbers are decoded character by character.
"""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict

#: Misread form -> what was printed.
CONFUSIONS = [
    ("b", "h"), ("h", "b"), ("c", "e"), ("e", "c"), ("f", "t"), ("t", "f"), ("o", "a"), ("a", "o"), ("v", "y"), ("l", "i"), ("i", "l"),
    ("ri", "n"), ("cl", "d"), ("ii", "u"), ("rn", "m"), ("vv", "w"), ("m", "in"), ("U", "ll"), ("h", "li"), ("n", "ti"), ("n", "ri"),
    ("a", "ci"), ("d", "cl"), ("m", "rn"), ("w", "vv"), ("u", "ii"), ("0", "o"), ("1", "i"), ("1", "l"), ("2", "z"), ("3", "e"), ("5", "s"),
    ("6", "b"), ("6", "G"), ("8", "B"), ("9", "g"), ("9", "q"), ("0", "O"), ("5", "S"), ("I", "l"), ("q", "g"), ("g", "q"), ("s", "5"),
]
#: Letters read in the place of digits.
DIGITS = [("l", "1"), ("O", "0"), ("S", "5"), ("B", "8"), ("I", "1"), ("Z", "2"), ("o", "0")]
#: Digits, some of them read as letters, or a single stroke.
NUMBER = r"^(?:(?=.*[0-9])[0-9lOSBIZo]+(?:\.[0-9lOSBIZo]+)?|l)$"
_NUMBER = re.compile(NUMBER)


def labels(src: str, tgt: str) -> list[str]:
    """The labels of the characters of src when it is edited to tgt."""
    if len(src) == len(tgt) == 1:
        return ["R:" + tgt]
    if len(src) == 1:
        return [f"R:{tgt[0]}+I:{tgt[1:]}"]
    return ["R:" + tgt[0], *["D"] * (len(src) - 1)]


_OPTIONS: dict[str, list[str]] = defaultdict(list)
for _s, _t in CONFUSIONS + DIGITS:
    for _c, _l in zip(_s, labels(_s, _t)):
        if _l not in _OPTIONS[_c]:
            _OPTIONS[_c].append(_l)

#: Strokes that a letter is drawn with, so that whatever is read for it has the same ones; `6` is read for letters of two kinds.
STROKES = {"i": "il1rtf", "ii": "nuhb68", "iii": "m", "c": "ce3", "ci": "aod0", "vv": "w", "v": "vy", "g": "gq9", "s": "s5", "z": "z2"}
_STROKES = str.maketrans({c: k for k, v in STROKES.items() for c in v})
_OTHER_SIX = str.maketrans({"6": "g"})


def strokes(token: str) -> list[str]:
    """The strokes of a token in lower case, in the one or two ways it can be meant."""
    low = token.lower()
    ways = [low.translate(_STROKES)]
    return ways if "6" not in low else [*ways, low.translate(_OTHER_SIX).translate(_STROKES)]


_BY_FIRST: dict[str, list[tuple[str, str]]] = defaultdict(list)
for _s, _t in CONFUSIONS + DIGITS:
    _BY_FIRST[_s[0]].append((_s, _t))


def align(token: str, word: str) -> list[tuple[int, str, str]] | None:
    """The fewest edits (place, read, printed) that turn the token into the word, letter case aside; None where there are none."""
    best: dict[tuple[int, int], list[tuple[int, str, str]]] = {(0, 0): []}
    open_ = [(0, 0)]
    while open_:  # places of the token in order
        i, j = here = open_.pop(0)
        done = best[here]
        steps = [(1, 1, done)] if i < len(token) and j < len(word) and token[i].lower() == word[j].lower() else []
        for s, t in _BY_FIRST.get(token[i], ()) if i < len(token) else ():
            if token.startswith(s, i) and word.startswith(t.lower(), j):
                steps.append((len(s), len(t), [*done, (i, s, t)]))
        for a, b, edits in steps:
            to = (i + a, j + b)
            if to not in best:
                open_.append(to)
                open_.sort()
            if to not in best or len(edits) < len(best[to]):
                best[to] = edits
    found = best.get((len(token), len(word)))
    return found or None


def is_number(token: str) -> bool:
    return bool(_NUMBER.match(token))


def features(p: str, i: int) -> tuple[str, ...]:
    """Features of character i of a token padded with two signs at each end."""
    a, b, c, d, e = p[i - 2], p[i - 1], p[i], p[i + 1], p[i + 2]
    return ("0" + c, "1" + b + c, "2" + c + d, "3" + b + c + d, "4" + a + b + c, "5" + c + d + e, "6" + a + b + c + d, "7" + b + c + d + e, "8" + a + b + c + d + e)


def pad(token: str) -> str:
    return "^^" + token + "$$"


class CharEditor:
    def __init__(self, weights: dict[str, float] | None = None):
        self.w = weights or {}

    def score(self, feats: tuple[str, ...], label: str) -> float:
        get, t = self.w.get, "|" + label
        return sum(get(f + t, 0.0) for f in feats)

    def margin(self, token: str, edits: list[tuple[int, str, str]]) -> float:
        """Score of the labels of the edits over that of keeping those characters."""
        p, out = pad(token), 0.0
        for at, src, tgt in edits:
            for k, label in enumerate(labels(src, tgt)):
                feats = features(p, at + k + 2)
                out += self.score(feats, label) - self.score(feats, "K")
        return out

    def number(self, token: str) -> str:
        """The best label of each character of a number, applied."""
        p, out = pad(token), []
        for i, c in enumerate(token):
            feats = features(p, i + 2)
            options = ["K", *("R:" + t for s, t in DIGITS if s == c)]
            best = max(options, key=lambda o: self.score(feats, o)) if len(options) > 1 else "K"
            out.append(c if best == "K" else best[2:])
        return "".join(out)

    def judged(self, token: str, word: str, counts: tuple[int, int, int, int]) -> tuple[float, float] | None:
        """(gain, rank) of the labels that give the word; None where no labels do.

        gain: how much better they are than keeping all. rank: which of several words is the likelier, by frequency and margin, further edits counting against it.
        counts: of the token, of it capitalised, of the word, of that capitalised.
        """
        edits = align(token, word)
        if not edits:
            return None
        margin, feats = self.margin(token, edits), evidence(*counts)
        gain = self.score(feats, "E") - self.score(feats, "K") + MARGIN * margin
        return gain, math.log(counts[2]) + 0.5 * margin - (len(edits) - 1)

    def joins_with_hyphen(self, head: str, tail: str, n_joined: int = 0, n_hyphen: int = 0) -> bool:
        """Whether the hyphen at a line end stays: by the letters around it and by how often the corpus has either form."""
        feats = join_features(head, tail, n_joined, n_hyphen)
        return self.score(feats, "H") > self.score(feats, "J")


#: Weight of the margin of the characters in the score of a whole sequence.
MARGIN = 0.01


def evidence(n: int, n_cap: int, n_word: int, cap_word: int) -> tuple[str, ...]:
    """Features of a whole label sequence: how much more frequent the word is than the token.

    A token that is only ever capitalised, where the word isn't, may be a name.
    """
    half_decades = min(8, max(-2, math.floor(2 * math.log10(n_word / n))))
    name = n_cap == n and 2 * cap_word < n_word
    return tuple(f"l{i}{name}" for i in range(-2, half_decades + 1))


def join_features(head: str, tail: str, n_joined: int = 0, n_hyphen: int = 0) -> tuple[str, ...]:
    """Features of the letters and, where the corpus has a form, of which one and how much more often."""
    a, b = head.lower()[-4:], tail.lower()[:4]
    known = ()
    if n_joined or n_hyphen:
        more = round(2 * math.log10((n_hyphen + 0.1) / (n_joined + 0.1)))
        side = "h" if n_hyphen > n_joined else "j"
        known = tuple(f"jn{side}{i}" for i in range(min(6, abs(more)) + 1))
    return ("j0", "j1" + a, "j2" + b, "j3" + a[-2:] + "-" + b[:2], "j4" + a + "-" + b, "j5" + head.lower(), "j6" + tail.lower(), *known)


def _noisy(word: str, rng: random.Random) -> tuple[str, list[str]] | None:
    """The word with one misreading, and the labels that undo it."""
    number = word[0].isdigit()
    fits = [(s, t) for s, t in (DIGITS if number else CONFUSIONS) if t in word]
    if not fits:
        return None
    s, t = rng.choice(fits)
    at = rng.choice([m.start() for m in re.finditer(re.escape(t), word)])
    noisy = word[:at] + s + word[at + len(t) :]
    return noisy, ["K"] * at + labels(s, t) + ["K"] * (len(word) - at - len(t))


#: Cases at least of either kind that the whole sequences are fitted on.
CASES = 4000
#: Decades by which a misread form is rarer than its word; by which a word of its own may be rarer than one it is like, a name than a common word.
MISREAD, OWN, NAME = (1.0, 4.5), (-1.0, 1.0), (-1.0, 2.9)


def train(words: list[str], epochs: int = 2, seed: int = 7) -> CharEditor:
    """Fit on clean words of the corpus and on misread forms of them.

    words: a bounded sample, most frequent first. Words with a hyphen teach the
    line join to keep it, broken plain words to drop it.
    """
    rng = random.Random(seed)
    known, data, breaks = set(words), [], []
    for w in words:
        data.append((w, ["K"] * len(w)))
        for _ in range(2):
            n = _noisy(w, rng)
            if n and n[0] not in known:
                data.append(n)
        if "-" in w[1:-1]:
            at = w.index("-", 1)
            breaks += [(w[:at], w[at + 1 :], "H"), (w[: at + 3], w[at + 3 :], "J")]
        elif len(w) > 5 and w.isalpha():
            at = rng.randrange(2, len(w) - 2)
            breaks.append((w[:at], w[at:], "J"))
    for size in (10, 100, 1000, 10_000, 100_000) * 800:
        shown = str(rng.randrange(size)) + (f".{rng.randrange(100)}" if rng.random() < 0.3 else "")
        while n := _noisy(shown, rng):  # several digits of a number may be misread
            data.append(n)
            if rng.random() < 0.7 or not any(t in n[0] for _, t in DIGITS):
                break
            data.append(_twice(n, rng))
            break
    w: dict[str, float] = defaultdict(float)
    total: dict[str, float] = defaultdict(float)
    step = 1

    def update(feats, gold, guess):
        for f in feats:
            w[f + "|" + gold] += 1
            total[f + "|" + gold] += step
            w[f + "|" + guess] -= 1
            total[f + "|" + guess] -= step

    def best(feats, options):
        return max(options, key=lambda o: sum(w.get(f + "|" + o, 0.0) for f in feats))

    for _ in range(epochs):
        rng.shuffle(data)
        for token, gold in data:
            p = pad(token)
            for i, g in enumerate(gold):
                options = ["K", *_OPTIONS.get(token[i], ())]
                if len(options) > 1:
                    feats = features(p, i + 2)
                    guess = best(feats, options)
                    if guess != g:
                        update(feats, g, guess)
                step += 1
        for head, tail, g in (b for _ in range(5) for b in rng.sample(breaks, len(breaks))):
            # the corpus knows the form, the other one less often or not at all, or it knows neither
            n = rng.choice((0, 0, 1, 5, 50, 500))
            less = int(n * 10 ** -rng.uniform(0.4, 3))
            feats = join_features(head, tail, *((n, less) if g == "J" else (less, n)))
            guess = best(feats, ("J", "H"))
            if guess != g:
                update(feats, g, guess)
            step += 1
    editor = CharEditor({k: round(v - total[k] / step, 3) for k, v in w.items()})
    editor.w = {k: v for k, v in editor.w.items() if v}
    # whole sequences: those of misread forms are right, those from a word of its own to one it is like are not
    cases = []
    misread = [x for x in ((token, _edits(token, gold)) for token, gold in data if not token[0].isdigit()) if x[1]]
    for token, edits in misread * (1 + CASES // max(1, len(misread))):
        margin, name = MARGIN * editor.margin(token, edits), rng.random() < 0.15
        for decades, g in ((MISREAD if not name else (NAME[1], MISREAD[1]), "E"), (NAME if name else OWN, "K")):
            n = max(1, round(10 ** (6 - rng.uniform(*decades))))
            cases.append((evidence(n, n if name else 0, 10**6, 0), margin, g))
    w, total, step = defaultdict(float), defaultdict(float), 1
    for _ in range(epochs):
        rng.shuffle(cases)
        for feats, margin, g in cases:
            guess = "E" if sum(w.get(f + "|E", 0.0) - w.get(f + "|K", 0.0) for f in feats) + margin > 0 else "K"
            if guess != g:
                update(feats, g, guess)
            step += 1
    editor.w |= {k: x for k, v in w.items() if (x := round(v - total[k] / step, 3))}
    return editor


def _twice(noisy: tuple[str, list[str]], rng: random.Random) -> tuple[str, list[str]]:
    """A number with a second digit misread."""
    token, gold = noisy
    at = rng.choice([i for i, c in enumerate(token) if any(t == c for _, t in DIGITS)])
    s, t = rng.choice([x for x in DIGITS if x[1] == token[at]])
    return token[:at] + s + token[at + 1 :], [*gold[:at], "R:" + t, *gold[at + 1 :]]


def _edits(token: str, gold: list[str]) -> list[tuple[int, str, str]]:
    """The edits that labels stand for."""
    out, i = [], 0
    while i < len(gold):
        if gold[i] != "K":
            n = 1
            while i + n < len(gold) and gold[i + n] == "D":
                n += 1
            out.append((i, token[i : i + n], gold[i][2:].replace("+I:", "")))
            i += n
        else:
            i += 1
    return out
