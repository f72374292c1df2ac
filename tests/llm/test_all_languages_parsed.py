from folioflow.llm import languages as g

SENTENCE = "every pupil measured the height of seven wooden blocks before lunch"
#: Holds the sentence in pieces of twelve characters, so a parse needs few phrases, but more than the text that holds it whole.
PIECES = " zq ".join(SENTENCE[i : i + 12] for i in range(0, len(SENTENCE), 12))


def test_every_language_is_parsed_to_its_end():
    judge = g.Judge({"aa": PIECES, "bb": SENTENCE, "cc": "no such words stand here at all", "ru": "каждый ученик измерил высоту"})
    p = g.plain(SENTENCE)
    many = judge.rates([g.plain("no such words"), p, p + p, g.plain("каждый ученик")])
    assert judge.rates([p])[0].tolist() == many[1].tolist()
    assert many[1][0] < 0.12 and judge.langs[many[1].argmin()] == "bb"
    # above 1 / 12 of a phrase a character, where a shortcut would have stopped
    assert 0.2 < many[1][2] < 1 and many[1][3] == 1
    assert judge.langs[many[3].argmin()] == "ru" and many[3][:3].tolist() == [1, 1, 1]


def test_accents_may_be_lost():
    a = g.codes(["déjà vu ß"]).tolist()
    assert a == g.codes(["deja vu s"]).tolist() and g.codes(["漢"]).tolist() == [0]
