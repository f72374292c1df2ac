"""The registered health queries use the default validator."""

from folioflow.plans import documents as plans
from folioflow.schemas import DATASET

TEXTS = [r"ok $\frac{1}{2}$", r"so $\frac{8q + a = 5$ holds", r"$}x{$ and $y$", "costs {5", None]


def plain(s):
    """Math segments of a text, and how many of them have unbalanced braces."""
    segments = [x for x in (s or "").split("$")[1::2] if x]
    bad = 0
    for x in segments:
        depth = least = 0
        for c in x:
            depth += (c == "{") - (c == "}")
            least = min(least, depth)
        bad += bool(depth or least)
    return len(segments), bad


def test_invalid_math_fails_in_every_health_query(spark, tmp_path):
    q = lambda i, text: (i, 1, text, [], 1, "x", None, None)
    rows = [(i, f"p/{i}", "p", "s", "insert", "a.pdf", 1, [q("1", text)], None) for i, text in enumerate(TEXTS)]
    spark.createDataFrame(rows, "dataset_id bigint, " + DATASET).write.parquet(f"{tmp_path}/datasets.parquet")
    got = {r.dataset_id: (r.math_segments, r.math_invalid, r.verdict) for r in plans.health_report(spark, str(tmp_path)).collect()}
    want = {i: plain(text) for i, text in enumerate(TEXTS)}
    assert got == {i: (n, bad, "FAIL" if bad else "PASS") for i, (n, bad) in want.items()}
    assert {i for i, (_, bad) in want.items() if bad} == {1, 2}
    assert {(r.verdict, r.n) for r in plans.verdict_rollup(spark, str(tmp_path)).collect()} == {("PASS", 3), ("FAIL", 2)}
    assert plans.worst_verdict(spark, str(tmp_path)).first().worst == "FAIL"
    texts = {r.dataset_id: r.report for r in plans.health_texts(spark, str(tmp_path)).collect()}
    assert all(texts[i].startswith(f"[{v}]") for i, (_, _, v) in got.items())
