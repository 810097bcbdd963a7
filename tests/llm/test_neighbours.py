"""Recall and scores against brute force, ties of copies, and vectors that take no part."""

import math

import numpy as np
import pytest

from spendlens.llm import neighbours
from spendlens.llm.curves import Orders, along_curve
from tests.conftest import SF_DIR

ROWS = "vec_id long, embedding array<float>"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], ROWS)


def brute(rows, every=100, k=10):
    """Exact lists of (rank, vec_id, score) by query; rows with one vector each."""
    good = {i: np.asarray(np.float32(v), np.float64) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    ids = np.array(sorted(good))
    out = {}
    for q in ids[ids % every == 0]:
        distances = np.sqrt(((np.stack([good[i] for i in ids]) - good[q]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, distances)) if ids[j] != q][:k]
        if order:
            out[int(q)] = [(r + 1, int(ids[j]), float(distances[j])) for r, j in enumerate(order)]
    return out


def got(df):
    out = {}
    for q, rank, i, score in sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()):
        out.setdefault(q, []).append((rank, i, score))
    return out


def same(a, b):
    assert a.keys() == b.keys()
    for q in a:
        assert [x[:2] for x in a[q]] == [x[:2] for x in b[q]]
        assert [x[2] for x in a[q]] == pytest.approx([x[2] for x in b[q]], abs=1e-9)


def recall(found, exact):
    hits = sum(len({x[1] for x in found.get(q, [])} & {x[1] for x in exact[q]}) for q in exact)
    return hits / sum(len(x) for x in exact.values())


def test_curve_visits_every_cell_in_steps_of_one():
    for dimensions, bits in ((2, 3), (3, 2), (4, 2), (8, 1)):
        side = np.arange(1 << bits)
        cells = np.stack(np.meshgrid(*[side] * dimensions), axis=-1).reshape(-1, dimensions)
        place = along_curve(cells, bits)
        assert sorted(place.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def test_codes_are_close():
    sample = np.random.default_rng(1).normal(size=(500, 16))
    orders = Orders.fitted(sample, 2)
    assert np.abs(orders.decode(orders.encode(sample)) - sample).max() <= orders.step.max()


@pytest.mark.parametrize("kind", ["uniform", "clusters"])
def test_recall(spark, kind, monkeypatch):
    draw = np.random.default_rng(4)
    vectors = draw.normal(size=(6000, 24))
    if kind == "clusters":
        vectors = draw.normal(size=(60, 24))[draw.integers(0, 60, 6000)] * 5 + vectors * 0.05
    rows = list(enumerate(vectors.tolist()))
    widths = []
    measured = neighbours.ranges_per_order
    monkeypatch.setattr(neighbours, "ranges_per_order", lambda *a: widths.append(measured(*a)) or widths[-1])
    found, exact = got(neighbours.nearest(table(spark, rows).repartition(7))), brute(rows)
    assert recall(found, exact) >= 0.9 and all(len(x) == 10 for x in found.values()) and found.keys() == exact.keys()
    assert widths[0] > 3 or kind == "uniform"  # clusters are found in short ranges


def test_recall_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert recall(got(neighbours.query(spark, SF_DIR)), brute(rows)) >= 0.9


def test_copies_and_ties(spark):
    draw = np.random.default_rng(2)
    vectors = draw.normal(size=(900, 6)).round(1)
    vectors[::3] = vectors[0]  # a third of all rows, queries among them
    vectors[1:60:4] = vectors[1]
    rows = list(enumerate(vectors.tolist()))
    same(got(neighbours.nearest(table(spark, rows).withColumnRenamed("vec_id", "vec_id"))), brute(rows))


def test_rows_that_take_no_part(spark):
    nan, inf = math.nan, math.inf
    good = [(100 * i, [i, 1, 2]) for i in range(1, 6)] + [(7, [3, 3, 3])]
    bad = [(0, [0, 0, 0]), (None, [1, 1, 1]), (900, None), (901, [1, None, 2]), (902, [1, nan, 2]), (903, [inf, 1, 2]), (904, [1, 2]), (905, [])]
    same(got(neighbours.nearest(table(spark, good + bad + good[:2]))), brute(good))


def test_extra_columns(spark):
    from pyspark.sql import functions as F

    df = table(spark, [(i, [i, i * i % 7, 1]) for i in range(0, 500, 50)])
    for name in ("vector", "h1", "rep", "query", "search", "score", "rank", "place", "distance", "label"):
        df = df.withColumn(name, F.lit("x"))
    same(got(neighbours.nearest(df)), brute([(i, [i, i * i % 7, 1]) for i in range(0, 500, 50)]))


def test_one_vector_for_each_id(spark):
    result = got(neighbours.nearest(table(spark, [(100, [1, 1]), (100, [5, 5]), (3, [1, 1]), (4, [5, 5])])))
    assert result in ({100: [(1, 3, 0.0), (2, 4, pytest.approx(32**0.5))]}, {100: [(1, 4, 0.0), (2, 3, pytest.approx(32**0.5))]})


def test_few_or_no_rows(spark):
    assert neighbours.nearest(table(spark, [])).collect() == []
    assert neighbours.nearest(table(spark, [(100, [1, 2])])).collect() == []
    assert neighbours.nearest(table(spark, [(1, [1, 2]), (2, [1, 2])])).collect() == []
