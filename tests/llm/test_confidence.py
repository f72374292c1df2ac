import numpy as np

from folioflow.llm import languages as g


def test_confidence_is_how_often_such_a_lead_is_right(spark):
    text = g.training_text(spark.read.parquet("/root/testdata/sf0.001/lang_samples.parquet"))
    half = {k: "\n".join(v.split("\n")[::2]) for k, v in text.items()}
    judge = g.Judge(half)
    judge.sure = g.calibrated(half)
    sure, right = [], []
    for k, v in text.items():
        words = [g.plain(s).split() for s in v.split("\n")[1::2]]
        held = [" ".join(w[i : i + n]) for w in words for n in (2, 4, 7) for i in range(0, len(w) - n, n)]
        for found in g.segments(held, judge):
            for lang, _, c, _ in found:
                sure.append(c)
                right.append(lang == k)
    sure, right = np.array(sure), np.array(right)
    assert len(sure) > 300 and abs(sure.mean() - right.mean()) < 0.06
    assert right[sure > 0.95].mean() > 0.93 and right[sure < 0.7].mean() < right[sure >= 0.7].mean()
    assert judge.confidence(0.5, 200) > judge.confidence(0.5, 10) > judge.confidence(0.1, 10)
