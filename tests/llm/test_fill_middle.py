"""Cuts, outputs and the way back against a plain split into units."""

import re
from hashlib import sha256

import pytest
from hypothesis import given
from hypothesis import strategies as st

from spendlens.llm import fill_middle
from tests.llm.small import documents, prose, with_clash

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)
TEXTS = st.text(alphabet=st.sampled_from("abZ <PSM>0é…漢😀\n"), max_size=80)


def brute(doc_id, text):
    units = UNIT.findall(text or "")
    digest = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or h[2] % 100 >= 90 or re.search("<[PSM]>", text):
        return n, "plain", None, None, text or ""
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@given(TEXTS, st.integers(1, 9))
def test_every_cut(text, block):
    found, units = fill_middle.Units(text.encode(), block), UNIT.findall(text)
    assert (found.n, found.n_chars) == (len(units), len(text))
    for after in range(len(units) + 1):
        before = "".join(units[:after])
        assert found.cut(after) == (len(before.encode()), len(before))


@given(TEXTS, st.integers(0, 500))
def test_output(text, doc_id):
    *rest, output = fill_middle.transformed(doc_id, text.encode())
    assert (*rest, output.decode()) == brute(doc_id, text)


def test_parts_of_a_long_text(monkeypatch):
    text = (prose(3, 4000) + "é" * 999 + "x" * 5000).encode()
    whole = fill_middle.Units(text)
    monkeypatch.setattr(fill_middle, "PART", 3000)
    parts = fill_middle.Units(text)
    assert (whole.tree == parts.tree).all()


@pytest.fixture(scope="module")
def rows(spark):
    texts = [None, "", "a", "<P> in it", "end <", "<<P", "S><", " ", "\n\n", "漢字 and more", "x" * 300_000 + " y", "x\x00y"]
    texts += [prose(i, 30) for i in range(60)]
    return [(i, t) for i, t in enumerate(texts)] + [(None, "no id here"), (5, "<<P"), (5, "another text")]


def test_rows(spark, rows):
    got = fill_middle.fill_in_middle(with_clash(documents(spark, rows))).withColumn("back", fill_middle.restored()).collect()
    assert sorted(str(tuple(r)[:6]) for r in got) == sorted(str((d, *brute(d, t))) for d, t in rows)
    texts = {d: t or "" for d, t in rows if d not in (5, None)}
    assert all(r["back"] == texts[r["doc_id"]] for r in got if r["doc_id"] in texts)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    assert fill_middle.report(documents(spark, [])).count() == 0
