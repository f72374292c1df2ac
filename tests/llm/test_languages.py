import random

import numpy as np
import pytest

from folioflow.llm import languages as g


@pytest.mark.parametrize(
    "label,code",
    [("en", "en"), ("EN-gb", "en"), ("English", "en"), ("Deutsch", "de"), ("pt_BR", "pt"), ("русский", "ru"), ("es (MX)", "es"), ("und", None), ("", None), (None, None), ("??", None), ("N/A", None), ("da", "da"), ("uk", "uk")],
)
def test_labels(label, code):
    assert g.label_code(label) == code


def parsed(automaton, texts):
    lengths = np.array([len(s) for s in texts])
    return automaton.phrases(np.frombuffer("".join(texts).encode(), np.uint8) - 96, np.cumsum(lengths) - lengths, lengths).tolist()


def phrases(text, s):
    n = i = 0
    while i < len(s):
        j = i + 1
        while j <= len(s) and s[i:j] in text:
            j += 1
        i = max(i + 1, j - 1)
        n += 1
    return n


def test_automaton_parses_like_brute_force():
    rng = random.Random(1)
    draw = lambda letters, least, most: "".join(rng.choice(letters) for _ in range(rng.randrange(least, most)))
    for _ in range(40):
        text, many = draw("abc", 1, 25), [draw("abcd", 0, 25) for _ in range(7)]
        assert parsed(g.Automaton([ord(c) - 96 for c in text], 5), many) == [phrases(text, s) for s in many]
    assert parsed(g.Automaton([1, 2], 5), ["", "ddd"]) == [0, 3] and parsed(g.Automaton([1, 2], 5), []) == []


@pytest.fixture(scope="module")
def samples(spark):
    return spark.read.parquet("/root/testdata/sf0.001/lang_samples.parquet")


def test_held_out_samples(samples):
    rows = sorted(samples.distinct().collect())
    by = {k: [r for r in rows if r.lang == k] for k in {r.lang for r in rows}}
    judge = g.Judge({k: "\n".join(r.text for r in v[10:]) for k, v in by.items()})
    held = [r for v in by.values() for r in v[:10]]
    right = sum([x[0] for x in found] == [r.lang] for r, found in zip(held, g.segments([r.text for r in held], judge)))
    assert right / len(held) >= 0.97


def test_documents(spark, samples):
    text = {r.lang: r.text for r in samples.collect()}
    docs = [
        (1, text["fr"], "fr", 1), (2, text["fr"], "en", 1), (3, text["de"] + "\n" + text["ru"], "de", 1), (4, text["es"], None, 1), (5, None, None, 1), (6, " \n", "en", 1), (7, "12 + 3 = 15", None, 1),
        (8, text["pt"], "Portuguese", 1), (9, text["pt"].replace("ã", "a").replace("ç", "c").replace("é", "e"), "und", 1),
    ]
    df = spark.createDataFrame(docs + docs[:3], "doc_id bigint, text string, lang string, seg_no int")
    got = sorted((r.doc_id, r.seg_no, r.lang) for r in g.needs_label(g.document_segments(df, samples)).collect())
    assert got == [(2, 1, "fr"), (3, 1, "de"), (3, 2, "ru"), (4, 1, "es"), (9, 1, "pt")]
    assert g.document_segments(df.limit(0), samples).count() == 0
    assert g.document_segments(df, samples.limit(0)).count() == 0


def test_sentences():
    assert g.sentences("1. Find x. Then stop!\n2. Go on") == ["Find x.", "Then stop!", "Go on"]
    assert g.sentences("a line\nthat goes on. [3]\n") == ["a line\nthat goes on."]
    assert g.sentences("") == []
