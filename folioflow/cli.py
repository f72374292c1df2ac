"""Command line: ocr, parts, md, report, build, upload, inspect, probe."""

from __future__ import annotations

import argparse
import json
import sys
from collections import Counter
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow import pipeline
from folioflow.config import Config
from folioflow.operators import datasets as ds
from folioflow.operators import parts, validate
from folioflow.session import drop_written
from folioflow.sinks import files as out
from folioflow.sources import files, ocr


def _session() -> SparkSession:
    return SparkSession.builder.appName("folioflow").getOrCreate()


def _storage(url: str = ""):
    from folioflow.sinks.storage import Storage, visitor_token

    c = Config.from_env()
    store = Storage(url or c.base_url, c.api_key, c.visitor_token or visitor_token(c.cache_dir), timeout=c.timeout_s, ca_bundle=c.ca_bundle)
    if not store.health():
        print("the store doesn't say that it is well", file=sys.stderr)
    return store


def _cache(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.parquet(folder)
    except AnalysisException:
        return None


def _reports(rows: DataFrame, key: str, math: bool = True) -> DataFrame:
    """(key, text, verdict): with the renderer's verdicts where it can be run."""
    counts = None
    if math and validate.available(validate.renderer()):
        counts = validate.judged_counts(rows, key, validate.renderer())
    valid = ds.m.is_valid if math else (lambda x: F.lit(True))
    return ds.health(rows, key, valid, counts).select(key, ds.report_text().alias("text"), "verdict")


def cmd_ocr(a, client=None, opener=files.open_pdf) -> int:
    """PDFs to dataset JSON, Markdown and figures. Exit 1 if there are no PDFs."""
    config = Config.from_env()
    if a.backend:
        config = config.__class__(**{**config.__dict__, "backend": a.backend})
    config.validate()
    named = []
    for p in a.pdfs:
        if "://" in p or Path(p).is_dir() or p.lower().endswith(".pdf"):
            named.append(p)
        else:
            print(f"skip (not a pdf): {p}", file=sys.stderr)
    spark = _session()
    pdfs = files.pdf_files(spark, *named) if named else None
    if pdfs is None or pdfs.isEmpty():
        print("no PDFs found", file=sys.stderr)
        return 1
    made = pipeline.read_documents(pdfs, config, _cache(spark, config.cache_dir), client, opener)
    out.append_cache(made.cache, config.cache_dir)
    out.write_dataset_files(made.datasets, a.out)
    out.write_markdown_files(made.datasets, a.out)
    out.write_assets(made.figures, a.assets)
    store = _storage() if a.upload else None
    reports = {r.doc_id: r.text for r in _reports(made.datasets, "doc_id").toLocalIterator()} if not store else None
    for r in made.datasets.select("doc_id").orderBy("doc_id").toLocalIterator():
        print(f"{r.doc_id}.json, {r.doc_id}.md", file=sys.stderr)
        if store:
            both = store.create_collection(2)
            for suffix in (".json", ".md"):
                print(store.upload(Path(a.out) / f"{r.doc_id}{suffix}", both["id"])["url"], file=sys.stderr)
            print(both["url"], file=sys.stderr)
    for text in (reports or {}).values():
        print(text, file=sys.stderr)
    return 0


def cmd_parts(a) -> int:
    """Page table to dataset JSON. Exit 1 if there are no pages."""
    pages = _session().read.parquet(a.pages)
    if pages.isEmpty():
        print("no pages", file=sys.stderr)
        return 1
    out.write_dataset_files(parts.datasets(pages), a.out)
    return 0


def cmd_md(a) -> int:
    """Dataset JSON to Markdown: a folder of files, or one file."""
    rows = files.read_datasets(_session(), a.json).withColumn("doc_id", F.regexp_extract("path", r"([^/]+)\.json$", 1))
    if Path(a.json).is_file():
        Path(a.out).write_text(rows.select(ds.dataset_markdown().alias("text")).first().text, encoding="utf-8")
    else:
        out.write_markdown_files(rows, a.out)
    return 0


def cmd_report(a) -> int:
    """Reports on standard output; unreadable files fail. Exit 1 if any dataset fails."""
    rows = files.read_datasets(_session(), a.json_dir, keep_broken=True)
    good = _reports(rows.filter("not broken"), "path", not a.no_math)
    bad = rows.filter("broken").select("path", F.concat(F.lit("[FAIL] "), "path", F.lit(": unreadable")).alias("text"), F.lit("FAIL").alias("verdict"))
    fail = False
    for r in good.unionByName(bad).orderBy("path").toLocalIterator():
        print(r.text)
        fail |= r.verdict == "FAIL"
    return int(fail)


def parse_selection(s: str) -> tuple[str, str] | None:
    paper, colon, part = s.partition(":")
    return (paper, part) if colon and paper and part else None


def cmd_build(a) -> int:
    """A custom paper of PAPER:ID selections, figures of --assets in the HTML. Exit 2 on a malformed one."""
    chosen = [parse_selection(s) for s in a.select]
    if None in chosen:
        print("a selection is PAPER:ID", file=sys.stderr)
        return 2
    spark = _session()
    sel = spark.createDataFrame([(i, p, q) for i, (p, q) in enumerate(chosen, 1)], "sel_no int, paper string, id string")
    index = ds.question_index(files.read_datasets(spark, a.json_dir), "path")
    found = ds.select_questions(sel, index)
    Path(a.out).write_text(ds.paper_markdown(found, a.title).first().markdown, encoding="utf-8")
    if a.html:
        images = files.image_files(spark, a.assets) if Path(a.assets).is_dir() else None
        Path(a.html).write_text(ds.paper_html(found, a.title, images).first().html, encoding="utf-8")
    s = ds.build_summary(found).first()
    print(f"{s.n} questions, {s.total_marks} marks, {s.missing} missing")
    for r in ds.missing_selections(sel, index).orderBy("sel_no").toLocalIterator():
        print(f"missing: {r.paper}:{r.id}")
    return 0


def cmd_upload(a) -> int:
    """Files to the store, in one collection if asked."""
    store = _storage(a.url)
    both = store.create_collection(len(a.files)) if a.collection else None
    if both:
        print(both["url"], file=sys.stderr)
    for f in a.files:
        print(f"{Path(f).name}: {store.upload(f, both and both['id'])['url']}")
    return 0


def cmd_inspect(a) -> int:
    """What the cache holds: the beginning of each response's text, with its elements by label."""
    cache = _cache(_session(), a.cache or Config.from_env().cache_dir)
    if cache is None:
        print("no cache", file=sys.stderr)
        return 1
    labels = F.transform("elements", lambda e: e["label"])
    for r in cache.select("key", F.left("markdown", F.lit(a.chars)).alias("text"), labels.alias("labels")).orderBy("key").limit(a.most).toLocalIterator():
        print(f"== {r.key} {dict(Counter(r.labels))}\n{r.text}\n")
    return 0


def cmd_probe(a, client=None, opener=files.open_pdf) -> int:
    """One page rendered at a resolution and read: the shape of the response, its labels and the beginning of its text."""
    config = Config.from_env()
    with opener(Path(a.pdf).read_bytes()) as pdf:
        pix = list(pdf)[a.page - 1].get_pixmap(dpi=a.dpi, alpha=False)
    answer = (client or ocr.make_client(config)).parse(pix.tobytes("png"), a.page)
    read = ocr.normalise(answer)
    print(f"{a.dpi} dpi, {pix.width} x {pix.height}")
    print("fields:", _shape(json.loads(answer)))
    print("labels:", dict(Counter(e["label"] for e in read["elements"])))
    print(read["markdown"][: a.chars])
    return 0


def _shape(v, depth: int = 3):
    """Names and kinds, lists by their first entry."""
    if isinstance(v, dict) and depth:
        return {k: _shape(x, depth - 1) for k, x in v.items()}
    if isinstance(v, list) and v and depth:
        return [_shape(v[0], depth - 1)]
    return type(v).__name__


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="folioflow", description=__doc__)
    sub = top.add_subparsers(required=True)

    def command(name, run, *args):
        p = sub.add_parser(name, help=(run.__doc__ or "").split("\n")[0])
        for flags, kw in args:
            p.add_argument(*flags, **kw)
        p.set_defaults(run=run)

    to = (["-o", "--out"], {"required": True})
    folder = (["--json-dir"], {"default": "out"})
    assets, chars = (["--assets"], {"default": "assets"}), (["--chars"], {"type": int, "default": 2000})
    command("ocr", cmd_ocr, (["pdfs"], {"nargs": "+"}), (["-o", "--out"], {"default": "out"}), assets, (["--backend"], {"choices": ["http", "mock"]}), (["--upload"], {"action": "store_true"}))
    command("parts", cmd_parts, (["pages"], {}), to)
    command("md", cmd_md, (["json"], {}), to)
    command("report", cmd_report, folder, (["--no-math"], {"action": "store_true"}))
    command("build", cmd_build, folder, (["--select"], {"nargs": "+", "required": True}), to, (["--html"], {}), assets, (["--title"], {"default": "Custom Paper"}))
    command("upload", cmd_upload, (["files"], {"nargs": "+"}), (["--url"], {"default": ""}), (["--collection"], {"action": "store_true"}))
    command("inspect", cmd_inspect, (["--cache"], {"default": ""}), (["--most"], {"type": int, "default": 10}), chars)
    command("probe", cmd_probe, (["pdf"], {}), (["page"], {"type": int}), (["--dpi"], {"type": int, "default": 300}), chars)
    return top


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        return a.run(a)
    finally:
        if spark := SparkSession.getActiveSession():
            drop_written(spark)


if __name__ == "__main__":
    sys.exit(main())
