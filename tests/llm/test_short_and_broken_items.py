from folioflow.llm import leaks as k

W = "alder birch cedar dogwood elm fir gorse hazel iris juniper kale lupin maple nettle oak pine quince rowan sorrel thyme ulex vetch willow yarrow zinnia aster briar clover daisy edelweiss".split()


def found(spark, texts, items):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    i = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    return sorted((r.doc_id, r.item_id) for r in k.leaks(d, i).collect())


def changed(words, at):
    return [*words[:at], "xxxxx", *words[at + 1 :]]


def test_two_pieces_with_a_changed_word_each(spark):
    one, two = changed(W[:10], 4), changed(W[20:], 5)
    text = " ".join(two) + " and then quite other words " + " ".join(one)
    item = " ".join(W)
    assert found(spark, [text, " ".join(one), " ".join(changed(W, 15))], [item]) == [(0, 0), (2, 0)]


def test_short_items(spark):
    items = [" ".join(W[:5]), " ".join(W[6:8]), W[9], "", None, " ".join(W[12:24])]
    texts = ["so " + " ".join(W[:5]) + " it is", "a juniper", "gorse and iris", " ".join(W[15:21]), " ".join(W[:3]), "nothing"]
    # half of the words in one passage is enough: two of the short items are held by a single word
    assert found(spark, texts, items) == [(0, 0), (1, 2), (2, 1), (3, 5), (4, 0)]


def test_rows_of_numbers_are_not_alike(spark):
    item = "read the values " + " ".join(map(str, range(10, 40)))
    d = spark.createDataFrame([(1, "table " + " ".join(map(str, range(500, 900))))], "doc_id bigint, text string")
    i = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    assert k.compared(d, i).count() == 0
    assert found(spark, ["table " + " ".join(map(str, range(15, 60)))], [item]) == [(0, 0)]
