"""Windows of test items in documents against brute force, spans in the original, shards."""

import hashlib
import re

import pytest

from spendlens.llm import decontaminate
from tests.llm.small import as_dict, documents, prose, with_clash

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item_id, item in items:
        v = words(item)
        k = min(10, len(v))
        grams = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if v else set()
        for i in range(len(w) - k + 1 if k else 0):
            if tuple(w[i : i + k]) in grams:
                hit.update(range(i, i + k))
                found.add(item_id)
    names = ",".join(sorted(map(str, found)))
    return len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)


ITEMS = [(1, prose(1, 30)), (2, "Short item, Ünder ten words!"), (30, prose(1, 12)), (4, None), (5, "..."), (6, prose(6, 10)), (7, prose(1, 30)), (8, "x")]
DOCS = [
    prose(50, 300), prose(51, 20) + " " + prose(1, 30).upper().replace(" ", " -- ") + " tail", "a short ITEM ünder ten words b", None, "", "!!",
    "short item Ünder ten words" * 2, "say short, item; Ünder (ten) words. x", prose(6, 10), prose(6, 9), "x", "xx " * 50 + "x x",
    " ".join(prose(1, 30).split()[5:17]), prose(1, 30) + " " + prose(1, 30), prose(9, 20_000) + " " + prose(6, 10),
]


@pytest.mark.parametrize("shard", [decontaminate.SHARD_BYTES, 150])
def test_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard)
    benchmark = spark.createDataFrame([*ITEMS, (None, prose(50, 20)), (1, prose(1, 30))], "item_id long, text string")
    docs = with_clash(documents(spark, DOCS))
    got = as_dict(decontaminate.report(docs, benchmark))
    assert len(got) == len(DOCS)
    for i, text in enumerate(DOCS):
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == brute(text, ITEMS), text
    clean = {r["doc_id"] for r in decontaminate.keep_clean(docs, benchmark).collect()}
    assert clean == {i for i, t in enumerate(DOCS) if not brute(t, ITEMS)[4]}


def test_spans_are_of_the_original(spark):
    text = "é “Før”: SHORT item, Ünder\n ten words — done"
    [row] = decontaminate.find(documents(spark, [text]), spark.createDataFrame(ITEMS[:2], "item_id long, text string")).collect()
    assert [text[s["start"] : s["end"]] for s in row["spans"]] == ["SHORT item, Ünder\n ten words"]


def test_empty_tables_and_repeated_rows(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(documents(spark, []), none).count() == 0
    docs = documents(spark, [(1, DOCS[1]), (1, DOCS[1]), (None, DOCS[1])])
    assert [r["contaminated"] for r in decontaminate.report(docs, none).collect()] == [False] * 3
    full = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert [r["contaminated"] for r in decontaminate.report(docs, full).collect()] == [True] * 3
    assert decontaminate.keep_clean(docs, none).count() == 3
