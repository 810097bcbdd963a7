"""Texts cut into pieces: what is encoded once, and ids as the library gives them for signs behind words."""

import itertools
import random

from spendlens.llm.tokens import VOCABULARY, Encoder, encoder

SIGNS = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]


def test_a_word_is_encoded_once_whatever_signs_follow():
    e, encoded = Encoder(VOCABULARY), []
    piece = e._piece
    e._piece = lambda key: encoded.append(key) or piece(key)
    text = " ".join(["first", *(f"wherer{end}" for end in ("", ",", ".", ".%%%", "!!", ",###", "...", "'s", "-", ")"))])
    assert e.encode(text) == e.whole(text)
    assert sum("wherer" in key for key in encoded) == 1
    e.encode(text.replace("wherer", "first").replace("first", "wherer", 1))
    assert len(encoded) == len(set(encoded))


def test_signs_behind_and_between_as_whole_texts():
    e = encoder(VOCABULARY)
    ends = ["a", "Z", "9", "é", "ſ", "×", "÷", "ª", "東", "ʼ", "ê", "²", "__", "'"]
    texts = [f"{a}{s}{b}" for a, b in itertools.product(ends, ends) for s in SIGNS]
    texts += [f"x {a}{s} {s}{b}\n{s}{a}" for a, b in itertools.product(ends[:6], ends[:6]) for s in SIGNS]
    texts += ["don't you'll we're 'tis x's, I'd.", "1.5 1,000.25% 3-4", "a.b.c,,d", "e.g. (i.e.) [x]{y}", "a_b __init__", "x'", "a\x00,b", "q \x00, r", "www.x.org/a?b=c&d#e"]
    for text in texts:
        assert e.encode(text) == e.whole(text), text


def test_random_texts_as_whole_texts():
    e, draw = encoder(VOCABULARY), random.Random(8)
    letters = [*"abzAZ059 \n", *"éÿſ×÷東ªʼ", *SIGNS, " ", " ", "'s", "'ll", "the"]
    for _ in range(5000):
        text = "".join(draw.choices(letters, k=draw.randint(1, 30)))
        assert e.encode(text) == e.whole(text), text
