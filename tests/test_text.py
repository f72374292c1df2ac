import pytest
from pyspark.sql import functions as F

from folioflow.functions import text as t


def one(spark, f, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("value,expected", [("CANDIDATE NAME ...", True), ("- blank page -", True), ("1 Find x", False), (None, None), ("", False)])
def test_front_matter(spark, value, expected):
    assert one(spark, t.is_front_matter, value) is expected


def test_junk_lines_go(spark):
    page = "![](page=3,bbox=[1, 2, 3, 4])\n$![](page=7)$\nreal content\n[Turn over]\nTrace ID 77"
    assert one(spark, t.clean_junk, page) == "real content"


@pytest.mark.parametrize("value,expected", [("a\nb\n", ["a", "b"]), ("a\r\nb", ["a", "b"]), ("a\n\nb", ["a", "", "b"]), ("", []), ("\n", [""])])
def test_lines(spark, value, expected):
    assert one(spark, t.lines, value) == expected


@pytest.mark.parametrize("value,expected", [("find x [3]", 3), ("(4 marks) [2]", 4), ("worth 12 marks", 12), ("[123]", None), ("none", None), (None, None)])
def test_first_mark(spark, value, expected):
    assert one(spark, t.first_mark, value) == expected


def inject(spark, page, numbers):
    df = spark.createDataFrame([(page, numbers)], "v string, n array<struct<n:int,y:double>>")
    return df.select(t.inject_number(F.col("v"), F.col("n")).alias("r")).first().r


def test_number_injection(spark):
    assert inject(spark, "Find x", [(4, 90.0), (3, 10.0)]) == "3. Find x"
    assert inject(spark, "3 Find x", [(3, 10.0)]) == "3 Find x"
    assert inject(spark, "CANDIDATE NAME\nFind", [(3, 10.0)]) == "CANDIDATE NAME\nFind"
    assert inject(spark, "![](page=2)\n\n(b) Find y", [(5, 1.0)]) == "5. (b) Find y"
    assert inject(spark, "Find x", []) == "Find x"
    assert inject(spark, "  ", [(3, 1.0)]) == "  "


def test_blocks_and_parts(spark):
    page = "heading\n1 Find x [2]\nmore\nQ2. (a) first [1]\n(b) second\nlast [4]\n3 stem text\n(i) roman [2]\n10β stays"
    parts = [(p.id, p.marks, p.text) for p in one(spark, t.prose_parts, page)]
    assert parts == [("1", 2, "Find x [2]\nmore"), ("2(a)", 1, "first [1]"), ("2(b)", 4, "second\nlast [4]"), ("3", None, "stem text"), ("3(i)", 2, "roman [2]\n10β stays")]


def test_nothing_to_segment(spark):
    assert one(spark, t.prose_parts, "no number here") == []
    assert one(spark, t.prose_parts, "") == []
    assert one(spark, t.prose_parts, "7") == []


def test_carry_prefix(spark):
    df = spark.createDataFrame([("  and so on", "4"), ("5 Find", "4"), ("text", None), (" ", "4")], "v string, n string")
    got = [r.r for r in df.select(t.carry_prefix(F.col("v"), F.col("n")).alias("r")).collect()]
    assert got == ["4 and so on", "5 Find", "text", " "]


def test_filename(spark):
    f = one(spark, t.parse_filename, "in/0580_w25_ms_41.pdf")
    assert tuple(f) == ("0580", "Oct/Nov 2025", "marking_scheme", "0580/41", "41")
    assert tuple(one(spark, t.parse_filename, "notes.pdf")) == ("", "", "unknown", "", None)


def test_names(spark):
    assert one(spark, t.safe_stem, "/a b/c d.e.pdf") == "c_d.e"
    assert one(spark, t.media_type, "x.PNG") == "image/png"
    assert one(spark, t.media_type, "x.bin") == "application/octet-stream"
    assert one(spark, t.html_escape, "<a & 'b' \"c\">") == "&lt;a &amp; &#x27;b&#x27; &quot;c&quot;&gt;"


def test_cache_key_is_sha1_of_nul_ended_parts(spark):
    import hashlib

    got = spark.range(1).select(t.cache_key(F.lit("a.pdf"), F.lit(3), F.lit(None)).alias("k")).first().k
    assert got == hashlib.sha1(b"a.pdf\x003\x00None\x00").hexdigest()


def test_sparse_pages_take_the_rebuilt_text(spark):
    df = spark.createDataFrame([("![](x)\n3", "a rebuilt page with much text"), ("a page with plenty of text on it", "other other other other"), ("", "short")], "v string, r string")
    got = [r.r for r in df.select(t.sparse_fallback(F.col("v"), F.col("r")).alias("r")).collect()]
    assert got == ["a rebuilt page with much text", "a page with plenty of text on it", ""]
