import json

import pytest

from folioflow import cli
from folioflow.operators import datasets as ds
from folioflow.schemas import DATASET
from folioflow.sinks import files as out
from folioflow.sources.files import pdf_files, read_datasets

Q = lambda i, marks=1, text="t", diagrams=None, answer=None, working=None, notes=None: (i, marks, text, diagrams or [], 1, answer, working, notes)


def frame(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows, 1)], "dataset_id bigint, " + DATASET)


def data(spark):
    a = ("p/1", "p", "s", "question_paper", "a.pdf", 2, [Q("1(a)", 3, "first", ["f.png"]), Q("1(b)", None, "second")], None)
    b = ("p/1", "p", "s", "marking_scheme", "b.pdf", 1, [Q("1(a)", 4, "later <&>", None, "x", "x"), None], ["r"])
    c = (None, None, None, None, None, None, None, None)
    d = ("p/2", "p", "s", "insert", "c.pdf", 1, [Q("1", 2, " ", None, ""), Q("1", 2), Q("A?", None)], None)
    return frame(spark, a, b, c, d).unionByName(frame(spark, a).limit(1))


def test_last_dataset_wins(spark):
    idx = {(r.paper, r.id): (r.dataset_id, r.marks) for r in ds.question_index(data(spark)).collect()}
    assert idx == {("p/1", "1(a)"): (2, 4), ("p/1", "1(b)"): (1, None), ("p/2", "1"): (4, 2), ("p/2", "A?"): (4, None)}


def test_custom_paper(spark):
    sel = spark.createDataFrame([(1, "p/1", "1(b)"), (2, "p/9", "1"), (3, "p/1", "1(a)"), (4, "p/1", "1(a)"), (4, "p/1", "1(a)")], "sel_no bigint, paper string, id string")
    idx = ds.question_index(data(spark))
    found = ds.select_questions(sel, idx)
    assert tuple(ds.build_summary(found).first()) == (3, 8, 1)
    assert [r.sel_no for r in ds.missing_selections(sel, idx).collect()] == [2]
    md = ds.paper_markdown(found).first().markdown
    assert md == "# Custom Paper\n\n## 1. (p/1 1(b))  [0 marks]\n\nsecond\n\n## 2. (p/1 1(a))  [4 marks]\n\nlater <&>\n\n## 3. (p/1 1(a))  [4 marks]\n\nlater <&>\n\n---\n**Total: 8 marks**"
    html = ds.paper_html(found, "A & B").first().html
    assert "<title>A &amp; B</title>" in html and "later &lt;&amp;&gt;" in html and "Total: 8 marks" in html
    assert ds.paper_markdown(found.filter("false")).first().markdown.endswith("**Total: 0 marks**")


def test_health(spark):
    rep = {r.dataset_id: r for r in ds.health(data(spark)).collect()}
    assert rep[1].verdict == "WARN" and rep[1].anomalies == ["missing marks: 1(b)"] and rep[1].total_marks == 3
    assert rep[2].verdict == "WARN" and rep[2].fallbacks == 1 and rep[2].questions == 1
    assert rep[3].verdict == "PASS" and rep[3].questions == 0
    assert rep[4].verdict == "FAIL" and rep[4].anomalies == ["duplicate id: 1 (x2)", "empty content: 1", "suspicious id: 'A?'", "missing marks: A?"]


def test_report_shows_twelve(spark):
    many = frame(spark, ("p", "", "", "insert", "", 1, [Q(str(i), None) for i in range(1, 16)], None))
    lines = ds.health(many).select(ds.report_text().alias("t")).first().t.split("\n")
    assert lines[0] == "[WARN] p (insert): 15 questions, 0 marks, math not validated (0/0 with balanced braces), 0 fallbacks" and len(lines) == 14 and lines[-1] == "    ... +3 more"


def test_dataset_markdown(spark):
    md = {r.dataset_id: r.m for r in data(spark).select("dataset_id", ds.dataset_markdown().alias("m")).collect()}
    assert "## 1(b)  (None marks)\n\nsecond\n" in md[1] and "![diagram](f.png)" in md[1]
    assert "**Working:**\n\nx\n" in md[2] and "**Answer:**" not in md[2]


def test_files_round_trip(spark, tmp_path, capsys):
    rows = data(spark).filter("dataset_id in (1, 2, 4)").distinct().selectExpr("concat('d', dataset_id) as doc_id", "* except (dataset_id)")
    out.write_dataset_files(rows, str(tmp_path / "json"))
    assert "answer" not in json.loads((tmp_path / "json/d1.json").read_text())["questions"][0]
    (tmp_path / "json/d9.json").write_text("{broken")
    back = read_datasets(spark, str(tmp_path / "json"))
    assert sorted(r.kind for r in back.collect()) == ["insert", "marking_scheme", "question_paper"]
    assert cli.main(["report", "--json-dir", str(tmp_path / "json")]) == 1
    shown = capsys.readouterr().out
    assert "[FAIL]" in shown and "unreadable" in shown
    assert cli.main(["build", "--json-dir", str(tmp_path / "json"), "--select", "p/1:1(a)", "p/1:99", "--out", str(tmp_path / "p.md"), "--html", str(tmp_path / "p.html")]) == 0
    assert "later <&>" in (tmp_path / "p.md").read_text() and "1 questions, 4 marks, 1 missing\nmissing: p/1:99" in capsys.readouterr().out
    assert cli.main(["build", "--json-dir", str(tmp_path / "json"), "--select", "nonsense", "-o", str(tmp_path / "q.md")]) == 2
    assert cli.main(["md", str(tmp_path / "json"), "-o", str(tmp_path / "md")]) == 0
    assert sorted(p.name for p in (tmp_path / "md").glob("*.md")) == ["d1.md", "d2.md", "d4.md"]
    assert cli.main(["md", str(tmp_path / "json/d1.json"), "--out", str(tmp_path / "one.md")]) == 0 and "## 1(b)" in (tmp_path / "one.md").read_text()
    out.write_datasets(rows, str(tmp_path / "by_kind"), ["kind"])
    assert (tmp_path / "by_kind/kind=insert").exists()


def test_pdf_files(spark, tmp_path):
    for name in ("b c.PDF", "a.pdf", "x.txt"):
        (tmp_path / name).write_bytes(b"%PDF")
    (tmp_path / "below").mkdir()
    (tmp_path / "below/n.pdf").write_bytes(b"%PDF")
    assert sorted(r.doc_id for r in pdf_files(spark, str(tmp_path)).collect()) == ["a", "b_c"]


def test_a_custom_paper_shows_its_figures(spark):
    sel = spark.createDataFrame([(20_001, "p", "1", True, 3, "text", ["/x/a.png", "gone.png"]), (7, "p", "2", True, None, "more", None), (9, "p", "3", False, None, None, None), (20_002, "p", "4", True, 1, None, ["a.png"])], "sel_no int, paper string, id string, found boolean, marks int, text string, diagrams array<string>")
    images = spark.createDataFrame([("/srv/a.png", bytearray(b"abc"))], "path string, content binary")
    cards = {r.no: (r.sel_no, r.card) for r in ds.html_cards(sel, images).collect()}
    assert [cards[i][0] for i in (1, 2, 3)] == [7, 20_001, 20_002]
    assert cards[2][1].count("<img") == 1 and "data:image/png;base64,YWJj" in cards[2][1] and "<img" in cards[3][1] and "<img" not in cards[1][1]
    html = ds.paper_html(sel, "T & <U>", images).first().html
    assert html.index("more") < html.index("text") and "T &amp; &lt;U&gt;" in html and "Total: 4 marks" in html


def test_a_cluster_needs_an_address():
    with pytest.raises(ValueError):
        out.file_system("relative/folder")
    assert out.file_system("file:///tmp/x")[1] == "/tmp/x" and out.file_system("x", shared=False)[1].endswith("/x")
