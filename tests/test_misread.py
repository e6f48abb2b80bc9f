"""Repair of misread text against a plain search over whole-text decodings."""

import random

from hypothesis import given
from hypothesis import strategies as st

from quarry.functions import misread

TOKENS = ["abc", "XYZ", "12", "café", "Ünï", "naïve", "ñandú", "ß", "Åø", "œuvre", "žena", "€", "£5", "©", "5°", "½", "×", "…", "–", "—", "“q”", "‘r’", "it’s", "•", "™", "Жищ", "αβγ", "日本", "😀", "à la"]


def misreading(text, encoding="cp1252"):
    """The bytes of a text read in another encoding, undefined ones as control characters."""
    return "".join(chr(b) if encoding == "cp1252" and b in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else bytes([b]).decode(encoding) for b in text.encode())


def plain(text, depth=4):
    """All whole-text ways back, the cheapest of them."""
    best = text
    todo = [(text, 0)]
    while todo:
        now, n = todo.pop()
        if misread.cost(now) < misread.cost(best):
            best = now
        if n == depth:
            continue
        for encoding in misread.ENCODINGS:
            try:
                table = {chr(b): b for b in range(0x80)} | misread._bytes_of(encoding)
                todo.append((bytes(table[c] for c in now).decode(), n + 1))
            except (KeyError, UnicodeDecodeError):
                continue
    return best


def test_generated_misreadings():
    rng = random.Random(4)
    for n in range(400):
        text = " ".join(rng.choice(TOKENS) for _ in range(rng.randint(1, 12)))
        wrong = text
        for _ in range(1 + n % 3):
            wrong = misreading(wrong)
        assert misread.repair(wrong) == text == plain(wrong, 1 + n % 3), (text, wrong)
    assert misread.repair(misreading("café – naïve", "mac_roman")) == "café – naïve"


def test_a_wrong_part_among_sound_text():
    assert misread.repair("sound é – and " + misreading("wrong é – ") + " Ã plain") == "sound é – and wrong é –  Ã plain"
    assert misread.repair("NÉ’s and ˆ˜ and É‘") == "NÉ’s and ˆ˜ and É‘"  # no phonetic script is made of it
    assert misread.repair(misreading(misreading("ˆ˜"))) == "ˆ˜"


@given(st.lists(st.sampled_from(TOKENS), max_size=12))
def test_sound_text_stays(tokens):
    text = " ".join(tokens)
    assert misread.repair(text) == text and misread.fix(misread.fix(text)) == misread.fix(text)


@given(st.text(max_size=60))
def test_fix_comes_to_rest(text):
    once = misread.fix(text)
    assert misread.fix(once) == once and not misread._CONTROL.search(once)


def test_fix():
    assert misread.fix(misreading("“It’s”")) == "\"It's\""
    assert misread.fix("&amp;lt; ﬁne Ｆｕｌｌ\u3000wide\r\nx\x07\ufeff") == "< fine Full wide\nx"
    assert misread.fix("<b>&amp;</b>") == "<b>&amp;</b>" and misread.fix("e\u0301") == "é" and misread.fix("\ud83d\ude00") == "😀" and misread.fix("") == ""
