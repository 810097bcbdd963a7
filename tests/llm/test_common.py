"""Hashes of words and runs of words."""

import numpy as np

from spendlens.llm import common
from tests.llm.small import prose


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = (prose(1, 3000) + " " + "x" * 500 + " tail").encode()
    whole, starts = common.word_hashes([text], common.ALNUM)
    monkeypatch.setattr(common, "LONG_BYTES", 200)
    parts, at = common.word_hashes([text], common.ALNUM)
    assert (whole == parts).all() and starts.tolist() == at.tolist() == [0, 3002]
    one, _ = common.word_hashes([b"y" * 1000], common.ALNUM)
    assert len(one) == 1


def test_equal_words_have_equal_hashes_anywhere():
    hashes, starts = common.word_hashes([b"One two, THREE", b"", b"two", "é É".encode()], common.ALNUM)
    assert starts.tolist() == [0, 3, 3, 4, 6]
    assert hashes[1] == hashes[3] and len(set(hashes.tolist())) == 5


def test_shingles_are_runs_within_texts():
    hashes, starts = common.word_hashes([b"a b c d e f", b"a b c d e", b"b c", b"", b"b c d e f"], common.SPACED)
    runs, at = common.shingles(hashes, starts, 5)
    assert np.diff(at).tolist() == [2, 1, 1, 0, 1]
    assert runs[0] == runs[2] and runs[1] == runs[4] and len(set(runs.tolist())) == 3


def test_slices_cover_all_texts():
    values = [b"x" * n for n in (1, 5, 100, 0, 3)]
    ranges = list(common.slices(values, 6))
    assert [i for a, b in ranges for i in range(a, b)] == [0, 1, 2, 3, 4]
    assert list(common.slices([])) == []
