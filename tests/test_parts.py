import random
import re

from pyspark.sql import functions as F

from folioflow.operators import parts as p

PART = "doc_id string, page int, ord bigint, id string, marks int, text string, answer string, working string, notes string"


def merged(spark, *rows):
    df = spark.createDataFrame([("d", *r) for r in rows], PART)
    return {r.id: r for r in p.merge_parts(df).collect()}


def test_merge(spark):
    m = merged(
        spark,
        (1, 1, "1", 2, "abc", "", "w1", ""), (2, 2, "1", None, "xyz", "A", "", "n"), (3, 3, "1", 5, " ", "B", "w2", ""),
        (3, 4, "2", None, " ", "", "kept", ""), (3, 5, "3", 1, "", "Available marks: 7", "", ""), (4, 6, "3", 2, "", "", "w", ""),
    )
    a = m["1"]
    assert (a.page, a.marks, a.text, a.answer, a.working, a.notes) == (1, 5, "abc", "B", "w1\nw2", "n")
    assert (m["2"].text, m["2"].working) == (" ", "kept")
    assert (m["3"].marks, m["3"].text) == (7, "w")


def test_stems(spark):
    df = spark.createDataFrame([("d", "8"), ("d", "8(a)"), ("d", "9"), ("e", "8"), ("d", None), ("d", "10(b)"), ("d", "1")], "doc_id string, id string")
    assert sorted((r.doc_id, str(r.id)) for r in p.drop_stems(df).collect()) == [("d", "1"), ("d", "10(b)"), ("d", "8(a)"), ("d", "9"), ("d", "None"), ("e", "8")]


SCHEME = "<table><tr><th>Question</th><th>Answer</th></tr><tr><td>{}</td><td>x</td></tr></table>"


def fold(pages):
    """The page-to-page state by plain steps: what each page finds carried."""
    carried, out = None, []
    for md in pages:
        out.append(carried)
        if re.search("BLANK PAGE", md):
            continue
        numbered = any(re.match(r"\s*\d{1,2}\b", x) for x in md.split("\n"))
        if carried and md.strip() and not numbered:
            md = f"{carried} {md.lstrip()}"
        ids = re.findall(r"<td>(\d+)", md)
        prose = re.sub(r"(?s)<table.*?</table>", "\n", md)
        blocks = []
        for line in prose.split("\n"):
            if m := re.match(r"\s*(\d{1,2})\b[\s.)]*(.*)", line):
                blocks.append([m[1], m[2]])
            elif blocks:
                blocks[-1][1] += line
        ids += [n for n, text in blocks if text.strip()]
        if ids:
            carried = ids[-1]
    return out


def test_carry_equals_a_sequential_fold(spark):
    rng = random.Random(3)
    make = [lambda: f"{rng.randrange(1, 40)} Find x", lambda: "plain words", lambda: "BLANK PAGE", lambda: "", lambda: SCHEME.format(rng.randrange(1, 40)), lambda: SCHEME.format(rng.randrange(1, 40)) + "\nheading", lambda: f"words\n{rng.randrange(1, 40)} y\nmore"]
    docs = {f"d{i}": [rng.choice(make)() for _ in range(rng.randrange(1, 7))] for i in range(150)}
    rows = [(d, i + 1, md) for d, ps in docs.items() for i, md in enumerate(ps)]
    got = {(r.doc_id, r.page): r.carried for r in p.carried_numbers(spark.createDataFrame(rows, "doc_id string, page int, markdown string")).collect()}
    want = {(d, i + 1): c for d, ps in docs.items() for i, c in enumerate(fold(ps))}
    assert got == want


def test_datasets_end_to_end(spark):
    page = "page_id bigint, doc_id string, page int, width int, height int, markdown string, elements array<struct<label:string,bbox:struct<x0:double,y0:double,x1:double,y1:double>,content:string>>"
    rows = [
        (1, "0580_w25_qp_41", 1, 100, 100, "1 stem\n(a) Find x [3]", [("Figure", (0.0, 60.0, 50.0, 100.0), None), ("text", None, None), None]),
        (2, "0580_w25_qp_41", 2, 100, 100, "(b) and y [2]", None),
        (2, "0580_w25_qp_41", 2, 100, 100, "(b) and y [2]", None),
        (3, "0580_w25_ms_41", 1, 100, 100, SCHEME.format("1(a)"), []),
        (4, "other", 1, 100, 100, None, None),
    ]
    d = {r.doc_id: r for r in p.datasets(spark.createDataFrame(rows, page)).collect()}
    qp = d["0580_w25_qp_41"]
    assert (qp.paper, qp.kind, qp.pages) == ("0580/41", "question_paper", 2)
    assert [(q.id, q.marks, q.diagrams, q.answer) for q in qp.questions] == [("1(a)", 3, ["0580_w25_qp_41_p1_fig1.png"], None), ("1(b)", 2, [], None)]
    assert [(q.id, q.answer) for q in d["0580_w25_ms_41"].questions] == [("1(a)", "x")]
    assert d["other"].questions == [] and d["other"].kind == "unknown"


def test_empty_tables(spark):
    df = spark.createDataFrame([], PART)
    assert p.merge_parts(df).count() == 0 and p.drop_stems(df).count() == 0
    assert p.carried_numbers(spark.createDataFrame([], "doc_id string, page int, markdown string")).select(F.count("*")).first()[0] == 0
