"""From PDF files to datasets, with a stand-in for the renderer and the OCR service."""

import json
import sys

import numpy as np
import pytest
from pyspark import cloudpickle

from folioflow import cli, pipeline
from folioflow.config import Config
from folioflow.functions import png
from folioflow.operators import validate
from folioflow.sources import files, ocr, pixels

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the workers don't have the tests on their path


@pytest.fixture
def opener():
    """Opens "PDFs" that are JSON: for each page its words and a grey level. Two dots a point at 144 dpi."""

    def open_(content):
        import numpy as np

        from folioflow.functions import png

        class Pix:
            def __init__(self, pixels):
                self.pixels, (self.height, self.width) = pixels, pixels.shape[:2]

            def tobytes(self, kind):
                return png.encode(self.pixels)

        class Rect:
            width, height = 100.0, 200.0

        class Page:
            rect = Rect

            def __init__(self, about):
                self.about = about

            def get_pixmap(self, dpi, alpha, clip=None):
                s = dpi / 72
                x0, y0, x1, y1 = clip or (0, 0, 100, 200)
                pixels = np.full((round((y1 - y0) * s), round((x1 - x0) * s), 3), 255, np.uint8)
                if self.about.get("ruled") and not clip:
                    for y in (40, 60, 80):
                        pixels[round(y * s), round(10 * s) : round(90 * s)] = 0
                    for x in (10, 50, 89):
                        pixels[round(40 * s) : round(80 * s), round(x * s)] = 0
                return Pix(pixels)

            def get_text(self, kind):
                return self.about.get("words", [])

        class Pdf(list):
            def __enter__(self):
                return self

            def __exit__(self, *error):
                pass

        return Pdf(map(Page, json.loads(content)))

    return open_


def answers(image, page):
    """A whole page is 200 points high; the second pass sees less of it."""
    height, width = png.decode(image).shape[:2]
    if height < 2 * width:
        return json.dumps({"md_results": "<table><tr><td>$3x+2=17 \\Rightarrow x=5$</td></tr></table>"})
    if page == 1:
        return json.dumps({
            "md_results": "Find the value of $x$. [3]\n\n<table><tr><td>3x+2=17</td></tr></table>",
            "layout_details": [[{"label": "table", "bbox_2d": [0.1, 0.35, 0.9, 0.55]}, {"label": "image", "bbox_2d": [0.1, 0.12, 0.4, 0.28]}]],
        })
    if page == 2:
        return json.dumps({"md_results": "and so on\n(a) more\n<table><tr><td>bad</td></tr></table>", "layout_details": []})
    return json.dumps({"md_results": "![](page=3)", "layout_details": []})


DOCUMENT = [
    {"words": [[5, 10, 9, 20, "1"], [80, 30, 90, 40, "[3]"]]},
    {"ruled": True, "words": [[80, 50, 90, 60, "[9]"], [80, 70, 90, 80, "[4]"]]},
    {"words": [[5, 10, 9, 20, "7."], [20, 10, 30, 20, "Rebuilt"], [31, 10, 60, 20, "from"], [61, 10, 90, 20, "text-layer"], [10, 30, 20, 40, "...."]]},
]


def folder(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/0580_w25_ms_41.pdf").write_text(json.dumps(DOCUMENT))
    return tmp_path / "in"


def test_whole_pipeline(spark, tmp_path, opener):
    config = Config(page_dpi=144, table_dpi=216)
    pdfs = files.pdf_files(spark, str(folder(tmp_path)))
    made = pipeline.read_documents(pdfs, config, None, ocr.MockClient(answers), opener)
    d = made.datasets.collect()
    assert len(d) == 1 and (d[0].kind, d[0].paper, d[0].pages) == ("marking_scheme", "0580/41", 3)
    by_id = {q.id: q for q in d[0].questions}
    # the number comes from the text layer, the table from the second pass, page 2 continues it
    assert [q.id for q in d[0].questions] == ["1(a)", "7"]
    assert "bad" not in str(d[0].questions) and by_id["1(a)"].marks == 4 and "Rebuilt from text-layer" in by_id["7"].text
    figures = made.figures.collect()
    assert [(f.page, f.fig_no, f.asset) for f in figures] == [(1, 1, "0580_w25_ms_41_p1_fig1.png")]
    assert png.decode(bytes(figures[0].content)).shape == (64, 60, 3)
    cache = made.cache
    assert cache.count() == 5  # three pages, a table the model saw and one found by its lines
    cache.write.parquet(str(tmp_path / "cache"))
    known = spark.read.parquet(str(tmp_path / "cache"))

    def never(image, page):
        raise AssertionError("asked again")

    again = pipeline.read_documents(pdfs, config, known, ocr.MockClient(never), opener)
    assert again.datasets.collect() == d and again.cache.count() == 0


def test_one_page(spark, tmp_path, opener):
    (tmp_path / "0580_w25_qp_41.pdf").write_text(json.dumps(DOCUMENT[:1]))
    made = pipeline.read_documents(files.pdf_files(spark, str(tmp_path)), Config(page_dpi=144, table_dpi=216), None, ocr.MockClient(answers), opener)
    (q,) = made.datasets.first().questions
    assert q.id == "1" and q.marks == 3 and "x=5" in q.text and "3x+2=17</td>" not in q.text.replace("$3x+2=17", "")
    assert q.diagrams == ["0580_w25_qp_41_p1_fig1.png"] and q.answer is None


def test_command(spark, tmp_path, opener, monkeypatch, capsys):
    monkeypatch.setenv("FOLIOFLOW_CACHE_DIR", str(tmp_path / "cache"))
    monkeypatch.setenv("FOLIOFLOW_PAGE_DPI", "144")
    a = cli.parser().parse_args(["ocr", str(folder(tmp_path)), "x.txt", "--out", str(tmp_path / "out"), "--assets", str(tmp_path / "assets")])
    assert cli.cmd_ocr(a, ocr.MockClient(answers), opener) == 0
    said = capsys.readouterr().err
    assert "skip (not a pdf): x.txt" in said and "0580_w25_ms_41.json" in said and "not validated" in said
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["0580_w25_ms_41.json", "0580_w25_ms_41.md"]
    assert (tmp_path / "assets/0580_w25_ms_41_p1_fig1.png").read_bytes()[:4] == b"\x89PNG"
    assert cli.main(["ocr", str(tmp_path / "nothing.txt")]) == 1
    assert cli.main(["inspect"]) == 0 and "Find the value" in capsys.readouterr().out
    a = cli.parser().parse_args(["probe", str(tmp_path / "in/0580_w25_ms_41.pdf"), "1", "--dpi", "72"])
    assert cli.cmd_probe(a, ocr.MockClient(answers), opener) == 0
    assert "'table': 1" in capsys.readouterr().out


def test_ruled_tables(opener):
    pix = opener(json.dumps([{"ruled": True}]))[0].get_pixmap(144, False)
    assert pixels.ruled_tables(pix.tobytes("png")) == [(20.0, 80.0, 180.0, 161.0)]
    assert pixels.ruled_tables(png.encode(np.full((50, 50, 1), 255, np.uint8))) in ([], [(0.0, 0.0, 50.0, 50.0)])


def test_png_round_trip():
    rng = np.random.default_rng(2)
    for channels in (1, 2, 3, 4):
        pixels_ = rng.integers(0, 256, (7, 5, channels), dtype=np.uint8)
        assert (png.decode(png.encode(pixels_)) == pixels_).all()
    with pytest.raises(ValueError):
        png.decode(b"GIF89a")


def test_png_filters():
    """Each filter undone by hand: what was written is the difference from the guess."""
    rng = np.random.default_rng(3)
    want = rng.integers(0, 256, (2, 6, 1), dtype=np.uint8)
    above, line = want[0].astype(int), want[1].astype(int)
    left = np.concatenate([[[0]], line[:-1]])
    corner = np.concatenate([[[0]], above[:-1]])

    def paeth(a, b, c):
        return min((a, b, c), key=lambda x: abs(a + b - c - x))

    guesses = {0: 0 * line, 1: left, 2: above, 3: (left + above) // 2, 4: np.array([[paeth(*x)] for x in zip(left.ravel().tolist(), above.ravel().tolist(), corner.ravel().tolist())])}
    for kind, guess in guesses.items():
        assert (png._unfiltered(kind, ((line - guess) % 256).astype(np.uint8), want[0]) == want[1]).all()


def test_renderer_reads_latex(spark, tmp_path):
    stub = tmp_path / "stub.py"
    stub.write_text("import json, sys\nprint(json.dumps([{'id': x['id'], 'ok': 'bad' not in x['latex'], 'error': None if 'bad' not in x['latex'] else 'no'} for x in json.load(sys.stdin)]))")
    command = [sys.executable, str(stub)]
    assert validate.judge(["x", "bad"], command) == [(True, ""), (False, "no")]
    kind = "dataset_id bigint, paper string, series string, kind string, latex_repairs array<string>, questions array<struct<id:string,marks:int,text:string,diagrams:array<string>,page:int,answer:string,working:string,notes:string>>"
    df = spark.createDataFrame([(1, "p", "s", "k", None, [("1", 1, "so $bad$ and $x$", [], 1, None, None, None)]), (2, "p", "s", "k", None, [("1", 1, "plain", [], 1, None, None, None)])], kind)
    counts = validate.judged_counts(df, "dataset_id", command)
    from folioflow.operators import datasets as ds

    rep = {r.dataset_id: r for r in ds.health(df, counts=counts).select("*", ds.report_text().alias("t")).collect()}
    assert (rep[1].math_invalid, rep[1].verdict) == (1, "FAIL") and "KaTeX 1/2 valid" in rep[1].t and rep[2].verdict == "PASS"
    fixed = {r.dataset_id: r for r in validate.sanitized_datasets(df, command=command).collect()}
    assert fixed[1].questions[0].text == "so $\\text{bad}$ and $x$" and fixed[1].latex_repairs == ["1:text escaped invalid latex (bad)"] and fixed[2].latex_repairs == []
