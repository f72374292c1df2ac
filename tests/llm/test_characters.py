import pytest

from folioflow.llm import confusables as c

PARTS = "part_id bigint, text string, answer string, notes string, value string, field string"


@pytest.mark.parametrize(
    "value,clean",
    [
        ("bаlсоnу", "balcony"), ("οf", "of"), ("ϲһɑіn", "chain"), ("ﬁnd", "find"), ("５ K", "5 K"), ("a b d", "a b d"), ("be​ak⁠er", "beaker"),
        ("Nèkåvik", "Nèkåvik"), ("（m", "(m"), ("мoст", "мост"),
        ("мост «круг»", "мост «круг»"), ("18α + 3β = 9π", "18α + 3β = 9π"), ("y² − 3 × ½ “x” — a‐\nb", "y² − 3 × ½ “x” — a‐\nb"), ("Löbôlen", "Löbôlen"), ("plain", "plain"), ("", ""),
    ],
)
def test_consistent_form(value, clean):
    assert c.consistent(value) == clean
    assert c.consistent(clean) == clean


def test_skeletons_of_equal_looking_texts_are_equal():
    for a, b in (("bаlсоnу", "balcony"), ("ｋite", "kite"), ("é", "é"), ("x​y", "xy")):
        assert c.skeleton(a) == c.skeleton(b)
    assert c.skeleton("мост") != c.skeleton("most")


def parts(spark, *texts):
    return spark.createDataFrame([(i, t, None, "", "clash", "clash") for i, t in enumerate(texts)], PARTS)


def test_found(spark, rows):
    df = parts(spark, "tһe kite", "it is so, it is a box a box", "іѕ it so", "word «мост»", "3у + 2y + 5y", "18α", None, "", "line\nbreak", "Α box", "x² − 1 ¬\nto")
    df = df.unionByName(df)
    assert rows(c.found(df)) == [(0, "text"), (2, "text"), (4, "text"), (9, "text")]
    assert c.found(df.limit(0)).count() == 0


def test_a_letter_by_itself(spark, rows):
    assert rows(c.found(parts(spark, "lie in \u0251 line", "4 K and 5 K", "scale: 49.3 \u041a", "take \u03b1 = 3", "a\u00a0gap", "nai\u0308ve", "na\u00efve"))) == [(0, "text"), (2, "text"), (4, "text"), (5, "text")]


def test_token_forms_by_group(spark):
    values = spark.createDataFrame([(1, "f", "t\u04bbe"), (2, "f", "the caf\u00e9"), (3, "f", "cafe\u0301")], "id bigint, field string, value string")
    got = {r.token: (r.skeleton, r.form) for r in c.token_forms(c.odd_tokens(values, "id")).collect()}
    assert got == {"t\u04bbe": ("the", "the"), "caf\u00e9": ("cafe\u0301", "caf\u00e9"), "cafe\u0301": ("cafe\u0301", "caf\u00e9")}


def test_groups(spark):
    df = parts(spark, "kite", "kitе", "kite", "other", None)
    g = c.groups(df).collect()
    assert [(r.field, r.forms, r.n, r.most_usual) for r in g] == [("text", 2, 3, "kite")]


def test_long_text(spark):
    assert c.found(parts(spark, "a " * 200_000 + "bеd", "a bed")).count() == 1
