"""What a block of the join by pivots compares, and how few copies of questions and rows are shuffled for it."""

import numpy as np
import pytest

from spendlens.operators import knn_join
from spendlens.operators.knn_join import Cells, distances
from tests.test_knn_join import brute, clusters, table


def block(vectors, questions, k=5, skip_own=False, bounds=None):
    vectors, questions = np.asarray(vectors, float), np.asarray(questions, float)
    ids, names = np.arange(len(vectors))[::-1], np.arange(len(questions))
    bounds = np.full(len(questions), np.inf) if bounds is None else np.asarray(bounds, float)
    asked, row, d = knn_join.nearest_in_block(vectors, ids, questions, names, bounds, k, skip_own)
    return [(int(q), int(ids[r]), float(x)) for q, r, x in zip(asked, row, d)]


def all_pairs(vectors, questions, k=5, skip_own=False):
    vectors, ids, out = np.asarray(vectors, float), np.arange(len(vectors))[::-1], []
    for q, asked in enumerate(np.asarray(questions, float)):
        d = distances(asked, vectors)
        order = [j for j in np.lexsort((ids, d)) if not skip_own or ids[j] != q]
        out += [(q, int(ids[j]), float(d[j])) for j in order[:k]]
    return out


DRAW = np.random.default_rng(7)
NORMAL = DRAW.normal(size=(900, 12))
TABLES = {
    "even": NORMAL,
    "clusters": clusters(900),
    "ties": DRAW.integers(0, 3, (900, 3)),
    "copies": np.vstack([NORMAL[:1]] * 500 + [NORMAL[:400]]),
    "near copies": NORMAL[:1] + 1e-7 * NORMAL,
    "far from zero": 1e9 + NORMAL,
    "tiny": 1e-40 * NORMAL,
    "one vector": np.ones((50, 4)),
}


@pytest.mark.parametrize("skip_own", [False, True])
@pytest.mark.parametrize("name", list(TABLES))
def test_block_is_exact(monkeypatch, name, skip_own):
    monkeypatch.setattr(knn_join, "TILE", 32)
    monkeypatch.setattr(knn_join, "CHUNK", 128)
    monkeypatch.setattr(knn_join, "PAIRS", 1000)
    vectors = np.asarray(TABLES[name], float)
    questions = np.vstack([vectors[::-1][:60], vectors[:40] * 1.01, vectors[:2] * 1e30])
    want = all_pairs(vectors, questions, skip_own=skip_own)
    assert block(vectors, questions, skip_own=skip_own) == want
    fifth = [d for _, _, d in want[4::5]]
    assert block(vectors, questions, skip_own=skip_own, bounds=fifth) == want


def test_vectors_that_are_no_numbers_take_no_part():
    vectors = [[1, 1], [np.nan, 1], [2, 2], [np.inf, 0]]
    assert block(vectors, [[1, 1], [np.nan, 0]]) == [(0, 3, 0.0), (0, 1, pytest.approx(2**0.5))]
    assert block(vectors[1:2], [[1, 1]]) == []


def test_few_pairs_are_measured_in_doubles(monkeypatch):
    vectors, measured = np.random.default_rng(2).normal(size=(4000, 32)), []
    monkeypatch.setattr(knn_join, "distances", lambda point, rows: measured.append(len(rows)) or distances(point, rows))
    assert block(vectors, vectors[:200] + 0.1, k=10) == all_pairs(vectors, vectors[:200] + 0.1, k=10)
    assert 200 * 10 <= sum(measured) < 0.01 * 200 * 4000


def test_small_cells_share_a_place():
    draw = np.random.default_rng(4)
    rows = draw.integers(0, 300, 128)
    rows[5], rows[6] = 5000, 0
    cells = Cells(draw.normal(size=(128, 8)), rows, np.zeros(128), np.ones(128))
    places = knn_join.shared_places(cells, 1000)
    sizes = np.bincount(places, weights=rows)
    assert np.sum(sizes > 1000) == 1 and np.sum(places[rows > 0] == places[5]) == 1
    assert len(sizes) <= 3 + 2 * rows.sum() / 1000


def test_questions_are_copied_by_places_not_cells(spark, monkeypatch):
    """Where no cell can be left out, a question goes to as many places as hold all rows, not to every cell."""
    monkeypatch.setattr(knn_join, "BLOCK", 1000)
    asked, searched = [], knn_join._searched
    monkeypatch.setattr(knn_join, "_searched", lambda rows, asking, *more: asked.append(asking.count()) or searched(rows, asking, *more))
    store = np.random.default_rng(9).normal(size=(3000, 24))
    got = knn_join.knn_join(table(spark, store), table(spark, store[:50] + 0.3, "question_id"), "vec_id", "question_id", k=6)
    assert [tuple(r)[:3] for r in got.collect()] == [r[:3] for r in brute(store, store[:50] + 0.3, 6)]
    assert asked[0] == 50 and sum(asked) <= 50 * 6


def test_wide_vectors_come_in_shorter_blocks():
    assert knn_join._block_rows(64, 32_768) == 32_768
    assert knn_join._block_rows(4096, 32_768) == 1024
    assert knn_join._block_rows(10**8, 32_768) == 1
