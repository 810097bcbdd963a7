"""A few questions go to the rows: nothing of the store is shuffled, and the answers are those of the join by pivots."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlens.operators import documents, knn_join, retrieval
from tests.test_knn_join import brute, clusters, table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("store", [clusters(5000), np.random.default_rng(1).integers(0, 3, (6000, 3)), np.vstack([clusters(4500), [[np.nan] * 8] * 3])])
@pytest.mark.parametrize("skip_own", [False, True])
def test_few_questions_go_to_the_rows(spark, monkeypatch, store, skip_own):
    questions = [*store[:30] + 0.25, None, *store[50:60], [np.nan] * store.shape[1]]
    asked = lambda: knn_join.knn_join(table(spark, [*store, None]).repartition(5), table(spark, questions, "question_id"), "vec_id", "question_id", k=7, skip_own=skip_own)
    got = asked()
    text = plan(got)
    assert "CoGroup" not in text and "MapInArrow" in text
    before_search = text[text.index("MapInArrow") :]
    assert before_search.count("Exchange") == 1  # that of this test
    monkeypatch.setattr(knn_join, "FEW", 0)
    cells = asked()
    assert "CoGroup" in plan(cells)
    assert [tuple(r) for r in got.collect()] == [(*r[:3], pytest.approx(r[3], abs=1e-9)) for r in map(tuple, cells.collect())]
    if not skip_own and np.isfinite(store).all():
        assert [tuple(r)[:3] for r in got.collect()] == [r[:3] for r in brute(store, questions[:41], 7)]


def test_few_questions_with_text_ids(spark):
    texts = [f"contract {i % 4800} about {'road' if i % 3 else 'school'} repair {i % 7}" for i in range(5000)]
    store = spark.createDataFrame([(f"doc_{i}", t) for i, t in enumerate(texts)], "doc_id string, document string")
    store = documents.embed(store).select("doc_id", "embedding", "document", "embedder")
    questions = ["school repair", "road", ""]
    got = retrieval.ask_many(store, spark.createDataFrame(list(enumerate(questions)), "question_id long, question string"), k=4)
    for i, question in enumerate(questions):
        one = [(r["doc_id"], pytest.approx(r["distance"])) for r in retrieval.ask(store, question, k=4).collect()]
        assert [(r["doc_id"], r["distance"]) for r in got.where(F.col("question_id") == i).orderBy("rank").collect()] == one
    assert "BroadcastHashJoin" in plan(got) and "SortMergeJoin" not in plan(got)  # the texts stay where they are


def test_texts_meet_hits_without_a_shuffle_where_nothing_else_is_broadcast(spark):
    store = documents.embed(spark.range(5000).selectExpr("concat('doc_', id) AS doc_id", "concat('text ', id % 900) AS document"))
    asked = spark.createDataFrame([(0, "text 7")], "question_id long, question string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = retrieval.ask_many(store, asked)
        assert "BroadcastHashJoin" in plan(got) and got.count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
