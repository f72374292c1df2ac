"""Math segments judged by an outside renderer, and documents repaired by its verdicts."""

from __future__ import annotations

import json
import shutil
import subprocess
from collections.abc import Iterator
from functools import reduce
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions import math as m
from folioflow.operators.datasets import FIELDS, questions


def available(command: list[str]) -> bool:
    return bool(command) and shutil.which(command[0]) is not None


def judge(expressions: list[str], command: list[str], timeout: int = 60) -> list[tuple[bool, str]] | None:
    """(ok, error) of each expression by one call: JSON list of {id, latex, display} in, of {id, ok, error} out; None if the renderer can't be had."""
    if not available(command):
        return None
    try:
        asked = json.dumps([{"id": i, "latex": x, "display": False} for i, x in enumerate(expressions)])
        done = subprocess.run(command, input=asked, capture_output=True, text=True, timeout=timeout, check=True)
        by_id = {r["id"]: (bool(r["ok"]), r.get("error") or "") for r in json.loads(done.stdout)}
    except Exception:
        return None
    return [by_id.get(i, (True, "")) for i in range(len(expressions))]


def renderer() -> list[str]:
    """The command of the checker beside this package, which needs node and KaTeX."""
    return ["node", str(Path(__file__).resolve().parent.parent / "tools" / "check_math.js")]


def validated(segments: DataFrame, command: list[str], column: str = "content") -> DataFrame:
    """segments with ok, error and `validated`. Distinct contents are judged, a batch per call; without a renderer all pass, not validated."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = judge(b[column].tolist(), command)
            b["ok"] = [r[0] for r in got] if got else True
            b["error"] = [r[1] for r in got] if got else ""
            b["validated"] = got is not None
            yield b

    verdicts = segments.select(column).distinct().mapInPandas(run, f"{column} string, ok boolean, error string, validated boolean")
    return segments.join(verdicts, column, "left").withColumn("ok", F.coalesce("ok", F.lit(True)))


def judged_counts(datasets: DataFrame, order: str, command: list[str]) -> DataFrame:
    """(dataset_id, segments, invalid, validated) by a renderer: what health takes in the place of its own count."""
    each = F.flatten(F.array(*[m.math_segments(F.coalesce(F.col(f), F.lit(""))) for f in FIELDS]))
    segments = questions(datasets, order).select(order, F.explode(each).alias("content"))
    return validated(segments, command).groupBy(order).agg(F.count("*").alias("segments"), F.count_if(~F.col("ok")).alias("invalid"), F.every("validated").alias("validated"))


_SEGMENTS = "array<struct<is_math:boolean,content:string>>"


def sanitized_datasets(datasets: DataFrame, order: str = "dataset_id", valid=m.is_valid, command: list[str] | None = None) -> DataFrame:
    """(dataset_id, questions, latex_repairs): every text field repaired; math still invalid becomes literal text and is listed.

    What is invalid is judged by `valid`, or by the renderer of `command` where it can be run.
    """
    q = questions(datasets, order)
    for f in FIELDS:
        q = q.withColumn(f"s_{f}", F.when(F.coalesce(F.col(f), F.lit("")) != "", m.repair_segments(F.coalesce(F.col(f), F.lit("")))))
    ruled_out = F.array().cast("array<string>")
    if command and available(command):
        math = F.flatten(F.array(*[F.transform(F.filter(F.coalesce(F.col(f"s_{f}"), F.array().cast(_SEGMENTS)), lambda s: s["is_math"]), lambda s: s["content"]) for f in FIELDS]))
        bad_ones = validated(q.select(order, "ord", F.explode(math).alias("content")), command).filter("not ok")
        q = q.join(bad_ones.groupBy(order, "ord").agg(F.collect_set("content").alias("bad_")), [order, "ord"], "left")
        ruled_out = F.coalesce("bad_", ruled_out)
        bad = lambda x: F.array_contains(ruled_out, x)
    else:
        bad = lambda x: ~valid(x)
    none = F.array().cast("array<string>")

    def problems_of(f: str) -> Column:
        listed = F.filter(F.col(f"s_{f}"), lambda s: s["is_math"] & bad(s["content"]))
        return F.coalesce(F.transform(listed, lambda s: F.concat(F.coalesce("id", F.lit("None")), F.lit(f":{f} escaped invalid latex ("), F.left(s["content"], F.lit(40)), F.lit(")"))), none)

    problems = [problems_of(f) for f in FIELDS]
    fixed = {f: F.coalesce(m.join_segments(F.transform(F.col(f"s_{f}"), m.as_text_if(bad))), F.col(f)) for f in FIELDS}
    row = F.struct("ord", F.struct("id", "marks", fixed["text"].alias("text"), "diagrams", "page", *[fixed[f].alias(f) for f in FIELDS[1:]]).alias("q"), reduce(lambda a, b: F.concat(a, b), problems).alias("p"))
    by = q.select(order, row.alias("r")).groupBy(order).agg(F.array_sort(F.collect_list("r"), lambda a, b: a["ord"] - b["ord"]).alias("r"))
    return by.select(order, F.transform("r", lambda r: r["q"]).alias("questions"), F.flatten(F.transform("r", lambda r: r["p"])).alias("latex_repairs"))
