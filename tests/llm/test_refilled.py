from folioflow.llm import leaks as k

ITEM = "in March Klavik pays 12 crowns and Deiric pays 30 crowns while Klavik keeps 12 metres of rope and Deiric keeps 30 metres of wire until April"
REFILLED = "in August Belath pays 7 pounds and Rumain pays 95 pounds while Belath keeps 7 litres of rope and Rumain keeps 95 litres of wire until May"
#: Each value of the item has several values here.
MIXED = "in August Belath pays 7 pounds and Rumain pays 95 euros while Sorin keeps 8 litres of rope and Tovald keeps 96 grams of wire until May"


def run(spark, f, texts, item=ITEM):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    i = spark.createDataFrame([(7, item), (8, None), (9, "")], "item_id bigint, text string")
    return sorted((r.doc_id, r.item_id) for r in f(d.unionByName(d), i).collect())


def test_refilled_questions_have_a_query_of_their_own(spark):
    texts = ["before it " + REFILLED + " after it", MIXED, ITEM, "nothing of it", None, ""]
    assert run(spark, k.leaks, texts) == [(2, 7)]
    assert run(spark, k.refilled, texts) == [(0, 7)]


def test_a_value_has_one_counterpart():
    item, doc, mixed = (k.words_and_kinds(x) for x in (ITEM, REFILLED, MIXED))
    count = lambda d: k.matched(d[0], item[0], [0], kinds=(d[1], item[1]))
    assert count(doc) == len(item[0]) > 2 * count(mixed)
