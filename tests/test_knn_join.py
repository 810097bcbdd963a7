"""The join by pivots against comparing all pairs, and what it does not compare."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlens.operators import documents, knn_join, retrieval
from spendlens.operators.knn_join import Cells, distances


def table(spark, vectors, name="vec_id", first=0):
    rows = [(first + i, None if v is None else [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"{name} long, embedding array<double>")


def brute(store, questions, k):
    out = []
    for q, asked in enumerate(questions):
        if asked is not None:
            d = sorted((float(distances(np.asarray(asked, float), np.asarray([v], float))[0]), i) for i, v in enumerate(store) if v is not None)
            out += [(q, r + 1, i, x) for r, (x, i) in enumerate(d[:k])]
    return out


def clusters(n, centres=40, width=8, seed=3):
    draw = np.random.default_rng(seed)
    return draw.normal(size=(centres, width))[draw.integers(0, centres, n)] * 20 + draw.normal(size=(n, width))


@pytest.mark.parametrize("store", [clusters(3000), np.random.default_rng(1).normal(size=(700, 5)), np.random.default_rng(1).integers(0, 3, (900, 3))])
def test_same_as_all_pairs(spark, store):
    questions = [*store[:40] + 0.25, None, *store[50:60]]
    got = knn_join.knn_join(table(spark, [*store, None]), table(spark, questions, "question_id"), "vec_id", "question_id", k=7)
    assert [tuple(r) for r in got.collect()] == [(*r[:3], pytest.approx(r[3])) for r in brute(store, questions, 7)]


def test_blocks_and_a_hot_cell(spark, monkeypatch):
    monkeypatch.setattr(knn_join, "BLOCK", 100)
    monkeypatch.setattr(knn_join, "QUESTIONS", 16)
    store = clusters(1500)
    store[::3] = store[0]  # a third are copies: one cell, many blocks
    questions = [store[0]] * 50 + list(store[1:20])
    got = knn_join.knn_join(table(spark, store), table(spark, questions, "question_id"), "vec_id", "question_id", k=5)
    assert [tuple(r)[:3] for r in got.collect()] == [r[:3] for r in brute(store, questions, 5)]
    assert [r["vec_id"] for r in got.where("question_id = 0").collect()] == [0, 3, 6, 9, 12]


def test_cells_are_skipped(spark):
    store = clusters(4000)
    rows = table(spark, store).select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    pivots = knn_join.spread_pivots(store[:1000], 64)
    cells = knn_join.measured_cells(knn_join._belonging(rows, pivots), pivots)
    assert cells.rows.sum() == 4000
    asked = table(spark, store[:200], "question").select("question", F.col("embedding").alias("asked"), F.lit(8.0).alias("bound"))
    own = knn_join.visits(asked, cells, 10, home=True).count()
    others = knn_join.visits(asked, cells, 10, home=False).groupBy("question").count().agg(F.sum("count")).first()[0]
    assert own == 200 and own + others < 0.2 * 200 * (cells.rows > 0).sum()
    for i in range(20):  # whatever is skipped holds nothing within the bound
        needed = set(cells.needed(store[i], 8.0).tolist())
        home = [int(np.argmin(distances(v, pivots))) for v in store]
        assert all(home[j] in needed for j in np.flatnonzero(distances(store[i], store) <= 8.0))


def test_bound_holds_k_rows():
    store = clusters(500)
    pivots = knn_join.spread_pivots(store, 16)
    home = np.array([int(np.argmin(distances(v, pivots))) for v in store])
    radius = np.array([distances(v, pivots[[c]])[0] for v, c in zip(store, home)])
    numbers = [(np.sum(home == c), radius[home == c].min(), radius[home == c].max()) for c in range(len(pivots))]
    cells = Cells(pivots, *(np.array(x) for x in zip(*numbers)))
    for question in store[:30]:
        assert np.sum(distances(question, store) <= cells.bound(question, 12)) >= 12


def test_small_and_wrong_input(spark):
    questions = table(spark, [[1, 2]], "question_id")
    join = lambda store, **more: knn_join.knn_join(store, questions, "vec_id", "question_id", **more).collect()
    assert join(table(spark, [])) == [] and join(table(spark, [None])) == []
    assert [tuple(r) for r in join(table(spark, [[1, 2], [1, 2], [4, 6]]))] == [(0, 1, 0, 0.0), (0, 2, 1, 0.0), (0, 3, 2, 5.0)]
    assert [r["vec_id"] for r in join(table(spark, [[1, 2], [1, 2]]), skip_own=True)] == [1]
    with pytest.raises(Exception, match="another length"):
        join(table(spark, [[1, 2], [1, 2, 3]]))


def test_no_cross_join(spark):
    store = table(spark, clusters(300))
    plan = knn_join.knn_join(store, store.withColumnRenamed("vec_id", "q"), "vec_id", "q")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_many_questions_as_one_by_one(spark):
    texts = [f"contract {i} about {'road' if i % 3 else 'school'} repair {i % 7}" for i in range(60)]
    store = spark.createDataFrame([(f"doc_{i}", t) for i, t in enumerate(texts)], "doc_id string, document string")
    store = documents.embed(store).select("doc_id", "embedding", "document", "embedder")
    questions = ["school repair", "road", ""]
    asked = spark.createDataFrame(list(enumerate(questions)), "question_id long, question string")
    got = retrieval.ask_many(store, asked, k=4)
    for i, question in enumerate(questions):
        one = [(r["doc_id"], pytest.approx(r["distance"])) for r in retrieval.ask(store, question, k=4).collect()]
        assert [(r["doc_id"], r["distance"]) for r in got.where(F.col("question_id") == i).orderBy("rank").collect()] == one
    with pytest.raises(Exception, match="embedded with"):
        retrieval.ask_many(store.withColumn("embedder", F.lit("other")), asked).collect()
