import random

import pytest

from folioflow.llm import editor as e
from folioflow.llm import scanned as s

WORDS = "beaker pendulum library harbour tractor orange measure surface gradient volume stadium crystal window circle describe frequency kettle cross-section mirror timetable vertical correct gallery follows and the with from find which their between".split()
PAGE = "page_id bigint, doc_id string, page int, markdown string, line_no int"
PART = "part_id bigint, doc_id string, page int, text string, working string, word string"


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(5)
    line = lambda: " ".join(rng.choice(WORDS) for _ in range(9)) + "."
    pages = []
    for d in range(30):
        for p in (1, 2):
            body = [line() for _ in range(12)]
            pages.append([2 * d + p, f"d{d}", p, ["Northfield Examining Board — Physics"] + body + [f"Page {p + 1} of 3"]])
    pages[0][3][4] = "the tbe beaker and tne pendulurn in 1O6 or l3 units of"
    pages[0][3][6] = "the orange har-"
    pages[0][3][7] = "bour and a cross-"
    pages[0][3][8] = "section near the gal¬"
    pages[0][3][9] = ""
    pages[0][3][10] = "lery. Values in the list:"
    pages[0][3][11:11] = ["71", "2", "94"]
    pages[2][3][12] = "with the correct pen-"
    pages[3][3][1] = "dulum and the library of"
    pages[4][3][0] = "Northfield Examining Boar"
    pages[5][3][13] = "3"
    pages[6][3][5] = "8n - 12 = 4"
    rows = [(i, d, p, "\n".join(x), 0) for i, d, p, x in pages]
    parts = [(1, "d0", 1, "Find the win-\n\n- 2 -\nNorthfield Examining Board — Physics\n\ndow and fhe kettle.", None, "x"), (2, "d0", 1, None, "", "x"), (3, "d1", 1, "   ", "rnirror", "x")]
    return spark.createDataFrame(rows + rows[:3], PAGE), spark.createDataFrame(parts + parts, PART)


def test_defects(tables):
    got = {tuple(r) for r in s.defects(*tables).collect()}
    page = "ocr_pages.markdown"
    of = lambda i: {(r[2], r[3], r[4]) for r in got if r[0] == page and r[1] == i}
    assert of(1) == {(1, "header", ""), (5, "char", "the"), (5, "char", "pendulum"), (5, "char", "106"), (5, "char", "13"), (7, "hyphen", "harbour"), (8, "hyphen", "cross-section"), (9, "hyphen", "gallery"), (17, "pageno", "")} | ({(5, "char", "the")})
    assert (13, "hyphen", "pendulum") in of(3) and not any(k == "char" for _, k, _ in of(4))
    assert (1, "header", "") in of(5) and (14, "pageno", "") in of(6) and of(7) == {(1, "header", ""), (14, "pageno", "")}
    part = {r[1:] for r in got if r[0] == "parts.text"}
    assert part == {(1, 1, "hyphen", "window"), (1, 3, "pageno", ""), (1, 4, "header", ""), (1, 6, "char", "the")}
    assert {r[1:] for r in got if r[0] == "parts.working"} == {(3, 1, "char", "mirror")}


def test_repaired(tables):
    pages, parts = tables
    texts = s.texts(pages, parts)
    out = {(r.src, r.rec_id): r.text for r in s.repaired(texts, s.fit(texts, pages)).collect()}
    assert out["parts.text", 1] == "Find the window and the kettle."
    assert out["parts.working", 2] == "" and ("parts.text", 2) not in out
    assert out["ocr_pages.markdown", 3].endswith("with the correct pendulum") and out["ocr_pages.markdown", 4].startswith("and the library")
    assert "har-" not in out["ocr_pages.markdown", 1] and "cross-section" in out["ocr_pages.markdown", 1]


def test_empty_tables(tables):
    pages, parts = tables
    assert s.defects(pages.limit(0), parts.limit(0)).count() == 0


def test_editor_on_held_out_misreadings():
    rng = random.Random(9)
    model = e.train(WORDS)
    known = set(WORDS)
    hit = n = 0
    for w in WORDS * 4:
        noisy = e._noisy(w, rng)
        if noisy and noisy[0] not in known:
            n += 1
            assert set(e.strokes(noisy[0])) & set(e.strokes(w))
            found = {c: j for c in WORDS if (j := model.judged(noisy[0], c, (1, 0, 500, 9))) and j[0] > 0}
            hit += bool(found) and max(found, key=lambda c: found[c][1]) == w
    assert n > 50 and hit / n >= 0.95
    # kept: a word of its own, a name, a word that is no form of it
    assert model.judged("bat", "hat", (300, 0, 500, 9))[0] < 0 and model.judged("Bat".lower(), "hat", (2, 2, 500, 9))[0] < 0 and model.judged("beaker", "kettle", (1, 0, 500, 9)) is None
    assert [model.number(x) for x in ("2O2O", "17", "l3", "l", "1S.B")] == ["2020", "17", "13", "1", "15.8"]
    both = e.train([*WORDS, "cross-section", "low-voltage", "well-mixed", "right-angled"])
    assert both.joins_with_hyphen("semi", "circle", 0, 40) and not both.joins_with_hyphen("semi", "circle", 40, 0) and not both.joins_with_hyphen("cross", "wind", 30, 2)
    assert not model.joins_with_hyphen("beak", "er") and e.train(["cross-section", "low-voltage", "beaker"]).joins_with_hyphen("cross", "section")


def furniture(*words):
    bits = bytearray(s.FURNITURE_BITS // 8)
    for h in (h for w in words for x in s.furniture_entries(w) for h in s._probes(x)):
        bits[h >> 3] |= 1 << (h & 7)
    return s.Furniture(bytes(bits))


def test_furniture_filter(spark):
    words = ["northfield", "examining", "board", "9999/99"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    f = furniture(*words)
    assert s.furniture_filter(df) == f.bits and len(f.bits) * 8 == s.FURNITURE_BITS
    assert all(map(f.like, ["Northfield", "Northfie", "N0rthficlcl", "Boarcl,", "0580/41"])) and not any(map(f.like, ["nor", "bored", "exan", "", "12"]))
    assert f.header("Northfield Examining Board".split()) and f.header("0580/41".split()) and not f.header("the board of examiners met".split())
    long_ = ("Northfield Examining Board " * 8).split()
    assert len(long_) > 14 and f.header(long_)


def test_furniture_does_not_hang_on_the_size_of_the_corpus(spark):
    head = [(i, "Rare School Header\n" + "\n".join(f"line {j} of words" for j in range(9))) for i in range(s.EDGE_LEAST)]
    rest = [(i, "\n".join(f"other {i} text {j}" for j in range(9))) for i in range(100, 9000)]
    few, many = (spark.createDataFrame(x, "page_id bigint, markdown string") for x in (head, head + rest))
    want = {"rare", "school", "header"}
    assert want <= {r.word for r in s.furniture_words(few).collect()} and want <= {r.word for r in s.furniture_words(many).collect()}


def test_page_numbers_and_question_numbers():
    f = furniture("page")
    assert f.kinds(["— 4 —", "- 4 -", "[Page 4]", "P a g e  4", "p. 4", "4 / 9", "Pagc 4 9f 9"], 3) == ["pageno"] * 7
    assert f.kinds(["[4]", "- 3", "(4)", "4 cm", "−4"], 3) == [""] * 5
    assert f.kinds(["text:", "4", "17", "more"], 3) == [""] * 4
    assert f.kinds(["text", "", "4"], 3) == ["", "", "pageno"]
