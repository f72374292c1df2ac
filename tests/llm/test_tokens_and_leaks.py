import pytest

from folioflow.llm import leaks as k
from folioflow.llm import tokens as t

TEXTS = {1: "Hello world, it's 12 o'clock\n\n  x  ", 2: "", 3: None, 4: "Привет, мир! ½ été 😀 <|endoftext|>", 5: "a\tb\r\n", 6: " ", 7: "the the the", 8: "word " * 20_000, 9: "  nbsp   x"}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, s, "lang") for i, s in TEXTS.items()]
    return spark.createDataFrame(rows + rows[:2], "doc_id bigint, text string, ids string")


@pytest.mark.parametrize("hot", [t.HOT_WORDS, 2, 0])
def test_ids_equal_the_tokenizer(docs, hot):
    got = {r.doc_id: list(r.ids) for r in t.encoded(docs, hot_words=hot).collect()}
    assert got == {i: t.encoder(t.vocabulary()).encode_ordinary(s or "") for i, s in TEXTS.items()}


def test_round_trip(docs):
    assert {r.doc_id: r.text for r in t.decoded(t.encoded(docs)).collect()} == {i: s or "" for i, s in TEXTS.items()}


def test_no_documents(docs):
    assert t.encoded(docs.limit(0)).count() == 0


ITEM = "The owner of the heavy triangle insures it for 2282 crowns until Sunday. Klavik and Deiric share a hydraulic chimney in the ratio 40 to 15. Neither the regular ferry nor the bucket was touched until October."
REFILLED = "The owner of the liquid monument insures it for 50 crowns until August. Belath and Rumain share a copper kettle in the ratio 7 to 3. Neither the steep axle nor the archive was touched until March."


def found(spark, *texts, item=ITEM):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    i = spark.createDataFrame([(7, item), (8, "a held out text of other words that nobody wrote anywhere at all"), (9, None), (9, "")], "item_id bigint, text string")
    return sorted((r.doc_id, r.item_id) for r in k.leaks(d.unionByName(d), i).collect())


def test_leaks(spark):
    s = ITEM.split(". ")
    texts = [
        "before " + ITEM + " after", ITEM.upper(), s[1] + ". filler words in between. " + s[0], s[0] + " only", "<b>" + ITEM.replace(" ", "\n") + "</b>",
        ITEM.replace("hydraulic", "hydraulik").replace("ferry", "boat"), REFILLED, "", None, "nothing of it", ITEM.replace("Klavik", "Klävik"),
    ]
    assert found(spark, *texts) == [(0, 7), (1, 7), (2, 7), (4, 7), (5, 7), (10, 7)]


def test_short_pieces_do_not_count(spark):
    w = ITEM.split()
    scattered = " xx yy zz ".join(" ".join(w[i : i + 6]) for i in range(0, len(w), 6))
    assert found(spark, scattered) == []


def test_nothing_to_compare(spark):
    e = spark.createDataFrame([], "doc_id bigint, text string")
    i = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    assert k.leaks(e, i).count() == 0
    assert k.leaks(e.unionByName(spark.createDataFrame([(1, ITEM)], e.schema)), i.limit(0)).count() == 0


def test_templates():
    assert [x for _, x in k.tokens("In March Klavik took 12 metres.")] == ["in", "#p", "#p", "took", "#n", "#u"]
    assert k._close("plastic", "p1astic") and k._close("abcd", "abxcd") and not k._close("abcd", "axxd") and not k._close("ab", "ac")
