"""Licence phrases against brute force, fuzzy templates, the native plan, cases."""

import re

import pytest

from spendlens.llm import licences
from tests.llm.small import as_dict, documents, prose, with_clash

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return [w.decode() for w in WORD.findall((text or "").encode().lower())]


def brute(text):
    w, base, labels, score = words(text), [], {}, 0.0
    for t in licences.TEMPLATES:
        v, key = t.words.split(), licences._key_places(t)
        for i in range(len(w) - len(v) + 1):
            agree = sum(a == b for a, b in zip(w[i:], v))
            if all(w[i + k] == v[k] for k in key) and agree >= t.least * len(v):
                labels[t.label] = t.base
                score = max(score, agree / (len(v) + 1))
                if t.base:
                    base.append(i)
    join = lambda names: ",".join(sorted(names))
    return (
        len(w), len(base), min(base, default=None), max(base, default=None),
        join(n for n, b in labels.items() if b), join(labels), pytest.approx(score, abs=1e-6),
    )


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this library and associated documentation files"
TEXTS = [
    "Released under the MIT License.", "CC-BY and cc by, CC BY-NC 4.0!", "Licensed under the Apache License, Version 2.0.",
    "GNU General Public License, version 3. gnu general\npublic LICENSE", "gnu general license public", MIT, MIT.replace("free", "paid"),
    "by cc", "cc", "mit", "", None, "...", "é MIT\x00License", "MİT License", prose(1, 500) + " mit license " + prose(2, 500),
    "mit license " * 300, "Apache License", "x" * 5 + "apache license", "general public license", "all rights reserved",
    "Redistribution and use in source and binary forms, with or without changes are permitted provided that",
]


def test_against_brute_force(spark):
    got = as_dict(licences.report(with_clash(documents(spark, TEXTS))))
    columns = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    for i, text in enumerate(TEXTS):
        assert tuple(got[i][c] for c in columns) == brute(text), text


def test_index_posts_the_rarest_word(spark):
    common_words = ["general public version license"] * 50 + ["gnu"]
    rows = documents(spark, common_words).select(licences.words_of().alias("words"))
    [row] = licences.index(rows).collect()
    posted = {e["label"]: e["word"] for e in row["entries"]}
    assert posted["gpl"] == "gnu" and posted["lgpl"] in ("lesser", "affero")
    assert len(posted) == len(licences.TEMPLATES)


def test_cases(spark):
    assert licences.report(documents(spark, [])).count() == 0
    rows = documents(spark, [(1, "mit license"), (1, "mit license"), (None, "mit license")])
    assert [r["n_base"] for r in licences.report(rows).collect()] == [1, 1, 1]


def test_no_python_in_the_plan(spark):
    plan = licences.report(documents(spark, TEXTS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
