"""The stages one after the other, and their decisions against brute force."""

import pytest

import corpus_pipeline
from spendlens.llm import common, queries
from tests.conftest import SF_DIR
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.small import with_clash
from tests.llm.test_near_dedup import brute as duplicates

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder():
    return SF_DIR.replace("sf0.01", "sf0.001")


def test_stages_take_effect(spark, folder):
    docs = common.read(spark, folder, "documents")
    benchmark = [tuple(r) for r in common.read(spark, folder, "benchmark").collect()]
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        docs = common.kept(stage(spark, docs, folder))
        after = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert after <= set(before) and docs.count() == len(after)
        if name == "minhash_near_dedup":
            assert after == {d for d, (_, c) in duplicates(list(before.items())).items() if d == c}
        if name == "decontamination":
            assert after == {d for d, t in before.items() if not contaminated(t, benchmark)[4]}
        seen.append(after)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == COLUMNS
    assert seen[-1] == seen[-2]
    run = {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert run == seen[-1]


def test_stages_of_an_empty_table(spark, folder):
    docs = common.read(spark, folder, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = common.kept(stage(spark, docs, folder))
        assert docs.count() == 0


def test_queries_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


def test_stages_keep_columns_whatever_their_names(spark, folder):
    docs = with_clash(common.read(spark, folder, "documents"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = common.kept(stage(spark, docs, folder))
        assert out.columns == docs.columns, name
        assert out.count() and out.where("_score = 'x' AND _kept = 'x' AND _factor = 'x' AND _n = 'x' AND `a.b` = 'x'").count() == out.count()
