"""The grammar's clauses, what is learnt, held-out accuracy, cases."""

import random
import zlib

import pytest

from spendlens.llm import toxicity
from spendlens.llm.toxicity import Lexicon
from tests.llm.small import as_dict, documents, prose, with_clash

LABELS = "doc_id long, quality int, toxic int"
LEXICON = Lexicon({"idiot$": 6.0, "vequ": 5.0}, -2.0)


def weight(text):
    return sum(w for _, w in LEXICON.clauses(text, LEXICON.automaton()))


def test_clauses_are_scored_not_words():
    plain, target = weight("an idiot came"), weight("you idiot")
    assert plain == 6 and target == 7
    assert weight("he is not an idiot") == pytest.approx(7 * toxicity.DAMPED)
    assert weight("someone wrote idiot") == pytest.approx(6 * toxicity.DAMPED)
    assert weight("an idiot, not you") == 7  # the negation stands behind
    assert weight("Not today. You idiot!") == 7  # nor does it reach over a clause
    assert weight("idiotic idea") == 0 and weight("VEQUABLE thing") == 5
    assert weight("i will kill you") == pytest.approx(toxicity.THREAT + toxicity.TARGETED)
    assert weight("they will beat the eggs") > 0 == weight("a killing will come")
    assert weight("kill the process") == 0
    assert weight("idiot idiot. idiot") == 18


def test_machine_is_the_product_of_its_parts():
    sizes = [len(t) for t in toxicity.TRANSDUCERS.values()]
    total = 1
    for n in sizes:
        total *= n
    assert len(toxicity.MACHINE) == total
    assert all(after in toxicity.MACHINE for row in toxicity.MACHINE.values() for after in row)


def corpus(n, seed=1):
    """Texts in two languages; toxic ones hold words of two families."""
    draw = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = prose(seed * 10_000 + i, 80).split()
        toxic = i % 6 == 0
        if toxic:
            for _ in range(2):
                words.insert(draw.randrange(len(words)), draw.choice(["grobbel", f"zanthu{draw.choice('abcdefgh')}x", "flimp"]))
        texts.append(" ".join(words))
        labels.append((i, 1, int(toxic)))
    return texts, labels


def test_learns_families_and_holds_out(spark):
    texts, labels = corpus(900)
    docs = with_clash(documents(spark, texts))
    labelled = spark.createDataFrame([*labels, (None, 1, 1), (10**6, 1, 1), (3, None, None)], LABELS)
    rows = as_dict(toxicity.report(docs, labelled))
    assert {d for d, r in rows.items() if r["held_out"]} == {d for d in rows if zlib.crc32(str(d).encode()) % 4 == 2}
    toxic = {d for d, _, t in labels if t}
    assert {d for d, r in rows.items() if r["predicted"]} == toxic
    assert all((r["score"] >= 0.3) == bool(r["predicted"]) and 0 <= r["score"] <= 1 for r in rows.values())


def test_held_out_labels_are_not_learnt_from(spark):
    texts, labels = corpus(300)
    held = [r for r in labels if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert toxicity.learn(documents(spark, texts), spark.createDataFrame(held, LABELS)).stems == {}


def test_copies_of_one_document_teach_nothing(spark):
    texts, labels = corpus(600)
    copied = prose(77, 80) + " rareword here"
    texts += [copied] * 60
    labels += [(600 + i, 1, 1) for i in range(60)]
    stems = toxicity.learn(documents(spark, texts), spark.createDataFrame(labels, LABELS)).stems
    assert not any("rarewo" in s for s in stems) and any(s.startswith("grob") for s in stems)


def test_cases(spark):
    docs = documents(spark, [(1, None), (2, ""), (2, ""), (None, "text"), (3, "x " * 50_000)])
    for labels in ([], [(1, 1, 0)], [(1, 1, 1)]):
        rows = toxicity.report(docs, spark.createDataFrame(labels, LABELS)).collect()
        assert len(rows) == 5 and all(r["predicted"] == 0 for r in rows)
        assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False]
    none = documents(spark, [])
    assert toxicity.report(none, spark.createDataFrame([], LABELS)).count() == 0
    assert toxicity.keep_clean(docs, docs, spark.createDataFrame([], LABELS)).columns == docs.columns
