"""Totals kept by signed changes against counting again."""

from collections import Counter

import pytest
from tokenizers import Tokenizer

from spendlens.llm import common, token_counts
from spendlens.llm.token_counts import Rollup, counted, deletes, inserts, revisions
from spendlens.llm.tokens import VOCABULARY
from tests.llm.small import documents, prose, with_clash


def brute(rows):
    library = Tokenizer.from_file(VOCABULARY)
    docs, tokens = Counter(), Counter()
    for _, text, lang, source in rows:
        text = text or ""
        for name, n in ((token_counts.WORDS, len(text.encode().split())), (token_counts.PIECES, len(library.encode(text, add_special_tokens=False).ids))):
            docs[source, lang, name] += 1
            tokens[source, lang, name] += n
    return {(k, docs[k], tokens[k]) for k in docs}


def as_set(totals):
    return {((r["source"], r["lang"], r["tokenizer"]), r["documents"], r["tokens"]) for r in totals.collect()}


ROWS = [(i, prose(i % 17, 30), "en" if i % 3 else None, f"s{i % 4}") for i in range(60)] + [
    (100, "line\nline\nother", "fr", "s1"), (101, None, "fr", None), (102, "", "fr", None), (None, prose(1, 30), "en", "s1"), (5, prose(5, 30), "en", "s1"),
]


def test_maintained_totals(spark):
    got = as_set(token_counts.maintained(with_clash(documents(spark, ROWS)), common.shared_folder(spark, "t")))
    first = {}
    for d, t, *_ in ROWS:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    left = [(d, "\n".join(dict.fromkeys((t or "").split("\n"))), la, s) for d, t, la, s in ROWS if d is None or d == first[t or ""]]
    assert got == brute(left)


def test_changes_in_any_order_and_twice(spark):
    a, b = documents(spark, ROWS[:30]), documents(spark, ROWS[30:])
    new = documents(spark, [(d, f"{t} more", la, s) for d, t, la, s in ROWS[:10]])
    old = documents(spark, ROWS[:10])
    batches = [("a", inserts(counted(a))), ("b", inserts(counted(b))), ("r", revisions(counted(old), counted(new))), ("d", deletes(counted(b)))]
    want = brute([(d, f"{t} more", la, s) for d, t, la, s in ROWS[:10]] + ROWS[10:30])
    for order in (batches, batches[::-1]):
        rollup = Rollup(spark, common.shared_folder(spark, "t"))
        assert all(rollup.commit(n, c) for n, c in order)
        assert not rollup.commit("a", inserts(counted(b)))  # committed before: without effect
        assert as_set(rollup.totals()) == want
        rollup.fold("1")
        assert rollup.committed() == ["fold-1"] and as_set(rollup.totals()) == want
        assert not rollup.commit("b", inserts(counted(b)))
        assert rollup.commit("d2", deletes(counted(documents(spark, ROWS[10:30]))))
        rollup.fold("2")
        assert as_set(rollup.totals()) == brute([(d, f"{t} more", la, s) for d, t, la, s in ROWS[:10]])


def test_unfinished_batch_does_not_count(spark):
    rollup = Rollup(spark, common.shared_folder(spark, "t"))
    rollup.commit("a", inserts(counted(documents(spark, ROWS[:3]))))
    rollup._store().delete(rollup._path("a/_SUCCESS"), False)
    assert rollup.committed() == [] and rollup.totals().count() == 0
    assert rollup.commit("a", inserts(counted(documents(spark, ROWS[:3]))))
    assert as_set(rollup.totals()) == brute(ROWS[:3])
    with pytest.raises(ValueError):
        rollup.commit("fold-x", inserts(counted(documents(spark, []))))


def test_empty(spark):
    assert token_counts.maintained(documents(spark, []), common.shared_folder(spark, "t")).count() == 0
