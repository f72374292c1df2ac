import random

from folioflow.llm import scanned as s

WORDS = "beaker library harbour tractor orange measure surface gradient volume stadium crystal window circle pendulum mirror timetable vertical correct gallery".split()


def test_words_carried_over_pages_without_text(spark):
    rng = random.Random(5)
    body = lambda: [" ".join(rng.choice(WORDS) for _ in range(9)) + "." for _ in range(12)]
    page = lambda p, lines: "\n".join(["Northfield Examining Board — Physics", *lines, f"Page {p + 1} of 3"])
    rows = [(100 + 2 * d + p, f"d{d}", p, page(p, body())) for d in range(10) for p in (1, 2)]
    between = {"furniture": page(2, []), "blank": " \n", "null": None, "missing": "", "none": page(2, ["dulum and the library"]), "number": page(2, ["= 12 units"])}
    for i, (doc, text) in enumerate(between.items()):
        rows.append((3 * i, doc, 1, page(1, [*body(), "with the correct pen-"])))
        if doc != "missing":
            rows.append((3 * i + 1, doc, 2, text))
        rows.append((3 * i + 2, doc, 3, page(3, ["dulum and the library of", *body()])))
    pages = spark.createDataFrame(rows + rows[-3:], "page_id bigint, doc_id string, page int, markdown string")
    parts = spark.createDataFrame([], "part_id bigint, doc_id string, page int, text string, working string")
    texts = s.texts(pages, parts)
    model = s.fit(texts, pages)
    got = [(r.kind, r.rec_id, r.word or r.b) for r in s.detail(texts, model).filter("kind in ('hyphen', 'tail')").collect()]
    heads = {doc: 3 * i for i, doc in enumerate(between)}
    assert {(i, w) for k, i, w in got if k == "hyphen"} == {(i, "pendulum") for doc, i in heads.items() if doc != "number"}
    assert {i for k, i, _ in got if k == "tail"} == {heads[x] + 2 for x in ("furniture", "blank", "null", "missing")} | {heads["none"] + 1}
