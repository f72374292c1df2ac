from folioflow.llm import editor as e


def test_any_number_of_misreadings_is_aligned():
    word = "theoretical-illumination"
    token = "tbcorctlcal-iIIurninatlon"
    edits = e.align(token, word)
    assert len(edits) == 8 and set(e.strokes(token)) & set(e.strokes(word))
    back = token
    for at, s, t in reversed(edits):
        assert token.startswith(s, at) and (s, t) in e.CONFUSIONS + e.DIGITS
        back = back[:at] + t + back[at + len(s) :]
    assert back.lower() == word
    assert e.align("same", "same") is None and e.align("abc", "xyz") is None and e.align("a", "") is None


def test_every_confusion_keeps_the_strokes():
    for s, t in e.CONFUSIONS + e.DIGITS:
        assert set(e.strokes("xx" + s + "kk")) & set(e.strokes("xx" + t + "kk")), (s, t)


def test_other_letters_and_long_tokens():
    word = "électro-" + "aimantation" * 6
    assert e.align(word.replace("m", "rn"), word) and set(e.strokes(word)) & set(e.strokes(word.replace("m", "rn")))
