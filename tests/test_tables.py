import random

from pyspark.sql import functions as F

from folioflow.operators import tables

HEAD = "<tr><th>Question</th><th>Answer</th><th>Marks</th><th>Guidance</th></tr>"


def row(*cells):
    return "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"


def parts(spark, *htmls):
    pages = spark.createDataFrame([("d", 1, "x" + "".join(htmls) + "y")], "doc_id string, page int, markdown string")
    out = tables.scheme_parts(tables.table_rows(pages)).orderBy("table_no", "island").collect()
    return [(r.id, r.marks, r.answer, r.working, r.notes) for r in out]


def test_footers_give_the_total(spark):
    html = "<table>" + HEAD + row("3(a)", "x = -0.5", "M1", "g1") + row("3(a)", "Available marks: 5", "", "") + row("3(b)", "y", "A1", "") + row("3(b)", "Available marks:", "3", "g2") + "</table>"
    assert parts(spark, html) == [("3(a)", 5, "x = -0.5", "x = -0.5", "g1"), ("3(b)", 3, "y", "y", "g2")]


def test_best_method_counts_once(spark):
    html = "<table>" + HEAD + row("1", "a", "M1 A1", "") + row("1", "Or b", "B1", "") + row("1", "c", "", "") + "</table>"
    assert parts(spark, html) == [("1", 2, "c", "a\nOr b\nc", "")]


def test_leading_or_opens_no_method_of_its_own(spark):
    assert parts(spark, "<table>" + HEAD + row("1", "Or a", "M1", "") + row("1", "b", "M2", "") + "</table>")[0][1] == 3


def test_total_row_and_blank_ids(spark):
    html = "<table>" + HEAD + row("2", "a", "M1", "") + row("", "ignored", "9", "") + row("2", "", "4", "") + row("3", "b", "", "") + row("2", "c", "1", "") + "</table>"
    assert [(p[0], p[1]) for p in parts(spark, html)] == [("2", 4), ("3", None), ("2", 1)]


def test_other_tables_give_no_parts(spark):
    assert parts(spark, "<table><tr><td>a</td></tr><tr><td>1</td></tr></table>", "<table></table>") == []


def grids(spark, *htmls):
    df = spark.createDataFrame([(i, h) for i, h in enumerate(htmls)], "i int, markdown string")
    return [r.grids for r in tables.with_grids(df).orderBy("i").collect()]


def test_grid_spans(spark):
    spanned = '<table><tr><td rowspan="9">q</td><td>a</td><td>b</td></tr><tr><td>c</td><td>d</td></tr><tr><td colspan="2">e</td></tr><tr><td>x</td><td>y</td><td>z</td></tr><tr><td>s</td></tr></table>'
    plain = "<table><tr><td rowspan='x' colspan='2'>a<br>b &amp; c</td><td>d</td></tr><tr><td>open<td><b>e</b><!-- f --></td></tr><tr><td>lost</table>"
    wide = "<table><tr><td colspan=3>w</td><td rowspan=3>h</td></tr><tr><td>1</td><td colspan='2' rowspan=2>2</td></tr><tr><td>3</td><td>4</td></tr></table>"
    got = grids(spark, spanned, "x" + plain + spanned, wide, "none", None, "<table></table>")
    assert got[0] == [[["q", "a", "b"], ["q", "c", "d"], ["q", "e", ""], ["x", "y", "z"], ["s", "", ""]]]
    assert got[1] == [[["a\nb & c", "d"], ["e", ""]], got[0][0]]
    assert got[2] == [[["w", "", "", "h"], ["1", "2", "", "h"], ["3", "2", "4", "h"]]]
    assert got[3:] == [[], [], [[]]]


def sequential(rows):
    """The layout by plain steps, a place at a time."""
    width = max((sum(a for _, _, a in r) for r in rows), default=0)
    hanging, out = {}, []
    for row in rows:
        if sum(a for _, _, a in row) >= width:
            hanging = {}
        line, rest = [], list(row)
        while len(line) < width:
            left, text = hanging.get(len(line), (0, ""))
            if left:
                hanging[len(line)] = (left - 1, text)
                line.append(text)
            elif rest:
                text, down, across = rest.pop(0)
                if down > 1:
                    hanging[len(line)] = (down - 1, text)
                line += [text] + [""] * (across - 1)
            else:
                line.append("")
        out.append(line)
    return out


def test_spans_equal_a_sequential_layout(spark):
    rng = random.Random(8)
    many = [[[(f"t{rng.randrange(99)}", rng.choice([1, 1, 1, 2, 3, 5]), rng.choice([1, 1, 1, 2, 3])) for _ in range(rng.randrange(0, 5))] for _ in range(rng.randrange(0, 7))] for _ in range(400)]
    html = ["<table>" + "".join("<tr>" + "".join(f'<td rowspan="{d}" colspan="{a}">{x}</td>' for x, d, a in r) + "</tr>" for r in t) + "</table>" for t in many]
    assert [g[0] for g in grids(spark, *html)] == [sequential(t) for t in many]


def test_splice(spark):
    df = spark.createDataFrame(
        [("a<table>1</table>b<TABLE x>2</TABLE>c", ["<table>n</table>", " "]), ("no table", ["<table>n</table>", ""]), ("<table>1</table>", [])], "m string, r array<string>"
    )
    got = [r.x for r in df.select(tables.splice(F.col("m"), F.col("r")).alias("x")).collect()]
    assert got == ["a<table>n</table>b<TABLE x>2</TABLE>c", "no table\n\n<!-- rescued-table (unmatched) -->\n<table>n</table>", "<table>1</table>"]
