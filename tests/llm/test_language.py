"""Held-out accuracy, calibration, cases."""

import random
import zlib

import numpy as np

from spendlens.llm import language
from tests.llm.small import as_dict, documents, with_clash

SYLLABLES = {"aa": "the ing tion er and", "bb": "der ung sch ein ich", "cc": "que eau ment les é", "dd": "ción ado los ñ el"}


def text(lang, seed, n):
    draw = random.Random(seed)
    parts = SYLLABLES[lang].split()
    return " ".join("".join(draw.choices(parts, k=draw.randrange(1, 4))) for _ in range(n))


def table(n=400):
    langs = list(SYLLABLES)
    return [(i, text(langs[i % 4], i, 3 + i % 50), langs[i % 4], "s") for i in range(n)]


def test_held_out_accuracy(spark):
    rows = table()
    docs = documents(spark, [*rows, (1000, None), (1001, ""), (1002, "123 !?"), (1003, text("cc", 9, 200_000)), (1004, "x", None, "s"), (1004, "x", None, "s")])
    docs = with_clash(docs)
    got = as_dict(language.predict(docs, language.learn(docs)))
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert {d for d, r in got.items() if r["held_out"] and d < 1000} == {r[0] for r in held}
    assert np.mean([got[r[0]]["lang_pred"] == r[2] for r in held]) >= 0.98
    assert [got[d]["lang_pred"] for d in (1000, 1001, 1002)] == ["und"] * 3
    assert got[1003]["lang_pred"] == "cc" and got[1004]["lang_pred"] in SYLLABLES
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_weights_are_sparse_and_probabilities_calibrated():
    rng = np.random.default_rng(1)
    examples = []
    for i in range(800):
        label = i % 2
        places = rng.choice(500, 20, replace=False) + (100 if label and rng.random() < 0.8 else 0)
        found = np.zeros(language.FEATURES, dtype=np.int64)
        found[places] = 1
        examples.append((*language.weighted(found, np.ones(language.FEATURES)), label))
    weights, temperature = language.fit(examples, 2)
    assert 0 < (weights != 0).any(axis=1).sum() <= 601
    assert temperature > 0


def test_without_anything_to_learn_from(spark):
    docs = documents(spark, [(1, "text", None, "s"), (None, "text", "aa", "s"), (2, None, "aa", "s")])
    got = language.predict(docs, language.learn(docs)).collect()
    assert len(got) == 3 and all(r["lang_pred"] == "und" for r in got)
    none = documents(spark, [])
    assert language.predict(none, language.learn(none)).count() == 0
