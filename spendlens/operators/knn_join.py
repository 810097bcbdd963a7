"""Exact nearest rows for a table of questions, without comparing all pairs.

Stored vectors belong to the nearest of some pivots; a cell is what belongs to one pivot, with the smallest and largest
distance to it. A question first searches the cell of its own nearest pivot, which gives a bound on the distance of its
k-th neighbour. Other cells are visited only where the triangle inequality, or the plane halfway between two pivots,
allows something nearer than that bound.

Neighbouring small cells share a place, so that few copies of a question are shuffled where no cell can be left out. A
place is dealt in blocks of BLOCK rows and QUESTIONS questions, so a cell that holds a third of all rows, or that all
questions ask for, is many tasks. A block is searched by products of matrices in floats, with a margin for their
rounding; what is left is measured in doubles. Each block keeps k rows of a question; one aggregation merges them. What
the driver holds is bounded: a sample to take pivots from, and five numbers for each pivot.

Up to FEW questions are not worth a shuffle of the rows: every task searches its own rows for all of them and keeps k
for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, FloatType, IntegerType, StructField, StructType

from spendlens.functions.columns import first_asc
from spendlens.sources.published import stored

PIVOTS, SAMPLE = 128, 4096
PER_PIVOT = 32  # rows of the sample, at least
BLOCK, QUESTIONS = 32_768, 32_768
FEW = 4096  # questions that go to the rows, of which there are SAMPLE at least
COMPONENTS = 1 << 22  # of the vectors of a block, at most: wide vectors come in shorter blocks
TILE, CHUNK = 256, 4096  # questions and rows of one product
DENSE = 16  # times k rows of a chunk within the bound: the k-th of them becomes the bound
PAIRS = 1 << 22  # components measured at once
SLACK = 1e-9  # relative: rounding of a distance never drops a neighbour


@dataclass
class Cells:
    """Pivots with the number of rows of their cells and the range of their distances."""

    pivots: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def needed(self, question: np.ndarray, bound: float) -> np.ndarray:
        """Cells that may hold a row within ``bound`` of the question."""
        d = distances(question, self.pivots)
        limit = bound * (1 + SLACK) + SLACK
        near = (self.rows > 0) & (d - self.high <= limit) & (self.low - d <= limit)
        home = int(np.argmin(d))
        apart = distances(self.pivots[home], self.pivots)
        # the plane between the nearest pivot and another; rows of the other cell lie behind it
        behind = np.divide(d**2 - d[home] ** 2, 2 * apart, out=np.zeros_like(d), where=apart > 0)
        return np.flatnonzero(near & (behind <= limit * (1 + SLACK) + SLACK))

    def bound(self, question: np.ndarray, k: int) -> float:
        """A distance within which k rows lie, from the cells' numbers alone."""
        reach = distances(question, self.pivots) + self.high
        order = np.argsort(np.where(self.rows > 0, reach, np.inf))
        enough = np.searchsorted(np.cumsum(self.rows[order]), k)
        return float(reach[order[enough]]) if enough < len(order) else float("inf")


def distances(point: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Euclidean distances, summed component by component, so that they do not depend on the block."""
    return np.sqrt(np.cumsum((rows - point) ** 2, axis=1)[:, -1])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    if len(column) and (column.value_lengths().to_numpy() != width).any():
        raise ValueError(f"a vector has another length than {width}")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def _plain(df: DataFrame, vector: str) -> Column:
    """Vectors as they are shuffled: floats stay floats, half as wide, and become doubles where they are compared."""
    numbers = df.schema[vector].dataType.elementType
    return F.col(vector) if isinstance(numbers, FloatType) else F.col(vector).cast("array<double>")


def spread_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to n distinct vectors of the sample, each the farthest from those before."""
    chosen = [0]
    nearest = distances(sample[0], sample)
    while len(chosen) < n and nearest.max() > 0:
        chosen.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, distances(sample[chosen[-1]], sample))
    return sample[chosen]


def _belonging(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The rows (id, vector) with ``cell``, their nearest pivot, and ``radius``, the distance to it."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"), pivots.shape[1])
            squares = (vectors**2).sum(axis=1)[:, None] - 2 * vectors @ pivots.T + (pivots**2).sum(axis=1)
            cell = np.argmin(squares, axis=1) if len(vectors) else np.empty(0, np.int64)
            gaps = vectors - pivots[cell]
            radius = np.sqrt(np.einsum("ij,ij->i", gaps, gaps))
            more = [pa.array(cell, pa.int32()), pa.array(radius, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "cell", "radius"])

    schema = StructType([*rows.schema.fields, StructField("cell", IntegerType()), StructField("radius", DoubleType())])
    return rows.mapInArrow(assign, schema)


def measured_cells(belonging: DataFrame, pivots: np.ndarray) -> Cells:
    cells = Cells(pivots, np.zeros(len(pivots), np.int64), np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf))
    numbers = belonging.groupBy("cell").agg(F.count("*"), F.min("radius"), F.max("radius"))
    for cell, n, low, high in numbers.toLocalIterator():  # one row per pivot
        cells.rows[cell], cells.low[cell], cells.high[cell] = n, low, high
    return cells


def shared_places(cells: Cells, size: int) -> np.ndarray:
    """The place of every cell: neighbouring cells share one of up to ``size`` rows, a larger cell has its own."""
    places, place, filled = np.zeros(len(cells.pivots), np.int64), 0, 0
    left = cells.rows > 0
    at = int(np.argmax(left))
    while left.any():
        if filled and filled + cells.rows[at] > size:
            place, filled = place + 1, 0
        places[at], filled = place, filled + cells.rows[at]
        left[at] = False
        at = int(np.argmin(np.where(left, distances(cells.pivots[at], cells.pivots), np.inf)))
    return places


def visits(questions: DataFrame, cells: Cells, k: int, home: bool, places: np.ndarray | None = None) -> DataFrame:
    """The questions (question, asked, bound) once for each cell to search: their own, or all others needed.

    With ``places`` once for each place of such cells.
    """
    places = np.arange(len(cells.pivots)) if places is None else places

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("asked"), cells.pivots.shape[1])
            bounds = batch.column("bound").to_numpy(zero_copy_only=False)
            place, cell, limits = [], [], []
            for i, vector in enumerate(vectors):
                limit = min(float(bounds[i]), cells.bound(vector, k))
                nearest = np.where(cells.rows > 0, distances(vector, cells.pivots), np.inf)
                own = int(places[np.argmin(nearest)])
                wanted = [own] if home else [c for c in np.unique(places[cells.needed(vector, limit)]).tolist() if c != own]
                place += [i] * len(wanted)
                cell += wanted
                limits += [limit] * len(wanted)
            columns = [batch.column(name).take(pa.array(place, pa.int64())) for name in ("question", "asked")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(limits, pa.float64()), pa.array(cell, pa.int32())], names=["question", "asked", "bound", "cell"]
            )

    fields = questions.schema
    schema = StructType([fields["question"], fields["asked"], StructField("bound", DoubleType()), StructField("cell", IntegerType())])
    return questions.mapInArrow(chosen, schema)


def _values(column: pa.ChunkedArray) -> np.ndarray:
    return np.asarray(column.to_pylist()) if not pa.types.is_integer(column.type) else column.to_numpy()


def _first_of_equals(vectors: np.ndarray, order: np.ndarray, n: int) -> np.ndarray:
    """The rows in the given order, without those that n rows of the same vector come before."""
    vectors = np.ascontiguousarray(vectors[order])
    _, kind = np.unique(vectors.view(np.dtype((np.void, vectors.itemsize * vectors.shape[1])))[:, 0], return_inverse=True)
    by_kind = np.argsort(kind, kind="stable")
    sizes = np.bincount(kind)
    place = np.arange(len(kind)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return order[np.sort(by_kind[place < n])]


def _measured(questions: np.ndarray, vectors: np.ndarray, asked: np.ndarray, row: np.ndarray) -> np.ndarray:
    step = max(1, PAIRS // vectors.shape[1])
    parts = [distances(questions[asked[i : i + step]], vectors[row[i : i + step]]) for i in range(0, len(row), step)]
    return np.concatenate(parts) if parts else np.empty(0)


class _Block:
    """Rows of a block as floats around their mean, in units of the longest, with half of their squares beside them."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors, self.mean = vectors, vectors.mean(axis=0)
        rows = vectors - self.mean
        self.unit = float(np.sqrt((rows**2).sum(axis=1).max())) or 1.0
        rows /= self.unit
        self.floats = np.hstack([rows, -(rows**2).sum(axis=1)[:, None] / 2]).astype(np.float32)
        self.raw = float(np.abs(vectors).max())

    def near(self, questions: np.ndarray, limits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of question and row: at least the k nearest rows of each question within its limit."""
        asked = (questions - self.mean) / self.unit
        length = np.sqrt((asked**2).sum(axis=1))
        width = asked.shape[1] + 8
        single, double = (float(np.finfo(t).eps) * width for t in (np.float32, np.float64))
        raw = (np.abs(questions).max(axis=1) + self.raw) * width / self.unit
        margin = single * (length + 1) + double * (raw * (length + 1) + length**2) + 1e-30
        far = ~(length < 1e15)  # beyond floats: every row is measured
        asked[far], margin[far] = 0, np.inf
        floats = np.hstack([asked, np.ones((len(asked), 1))]).astype(np.float32)
        # half of (length^2 - distance^2): larger is nearer
        least = np.where(far, -np.inf, (length**2 - (limits / self.unit) ** 2) / 2 - margin)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for start in range(0, len(self.floats), CHUNK):
            rows = self.floats[start : start + CHUNK]
            nearness = floats @ rows.T
            within = nearness >= _float_below(least)[:, None]
            hits = np.flatnonzero(within)
            if len(rows) > k and len(hits) > DENSE * k * len(floats):
                least = np.maximum(least, _kth(nearness, k) - 2 * margin)
                hits = np.flatnonzero(nearness >= _float_below(least)[:, None])
            question, row = np.divmod(hits, len(rows))
            found.append((question, row + start, nearness.ravel()[hits]))
        question, row, nearness = (np.concatenate(c) for c in zip(*found))
        # the k-th nearest of all chunks
        order = np.lexsort((-nearness, question))
        question, row, nearness = question[order], row[order], nearness[order]
        first = np.searchsorted(question, np.arange(len(floats)))
        last = np.minimum(first + k, np.append(first[1:], len(question))) - 1
        enough = last - first == k - 1
        least[enough] = np.maximum(least[enough], nearness[last[enough]] - 2 * margin[enough])
        keep = nearness >= least[question]
        return question[keep], row[keep]


def _float_below(numbers: np.ndarray) -> np.ndarray:
    return np.nextafter(np.clip(numbers, -1e38, 1e38).astype(np.float32), np.float32(-np.inf))


def _kth(nearness: np.ndarray, k: int) -> np.ndarray:
    at = nearness.shape[1] - k
    return np.partition(nearness, at, axis=1)[:, at].astype(np.float64)


def nearest_in_block(
    vectors: np.ndarray, ids: np.ndarray, questions: np.ndarray, names: np.ndarray, bounds: np.ndarray, k: int, skip_own: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of questions and rows, and their distances: the k nearest rows of every question within its bound."""
    rank = np.empty(len(ids), np.int64)
    rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))
    more = k + skip_own  # own rows are dropped after the search
    rows = _first_of_equals(vectors, np.argsort(rank), more)
    rows = rows[np.isfinite(vectors[rows]).all(axis=1)]
    finite = np.flatnonzero(np.isfinite(questions).all(axis=1))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    if not len(rows):
        return found[0]
    block = _Block(vectors[rows])
    limits = bounds * (1 + SLACK) + SLACK
    for start in range(0, len(finite), TILE):
        tile = finite[start : start + TILE]
        asked, row = block.near(questions[tile], limits[tile], more)
        asked, row = tile[asked], rows[row]
        if skip_own:
            others = names[asked] != ids[row]
            asked, row = asked[others], row[others]
        d = _measured(questions, vectors, asked, row)
        order = np.lexsort((rank[row], d, asked))  # ties go to the smallest ids
        asked, row, d = asked[order], row[order], d[order]
        place = np.arange(len(asked)) - np.searchsorted(asked, asked)
        found.append((asked[place < k], row[place < k], d[place < k]))
    return tuple(np.concatenate(c) for c in zip(*found))


def _block_rows(width: int, rows: int) -> int:
    return max(1, min(rows, COMPONENTS // width))


def _searched(belonging: DataFrame, asking: DataFrame, cells: Cells, places: np.ndarray, k: int, skip_own: bool) -> DataFrame:
    """question, id, distance: of every block of a place the k nearest rows of each question that asks for it."""
    spark, width = belonging.sparkSession, cells.pivots.shape[1]
    blocks = -(-np.bincount(places, weights=cells.rows).astype(np.int64) // _block_rows(width, BLOCK))
    shapes = [(cell, int(place), max(1, int(blocks[place]))) for cell, place in enumerate(places)]
    sizes = spark.createDataFrame(shapes, "cell int, place int, blocks long")
    asking = asking.withColumnRenamed("cell", "place")
    parts = asking.groupBy("place").agg(F.ceil(F.count("*") / _block_rows(width, QUESTIONS)).alias("parts"))  # one row per place
    shape = sizes.join(F.broadcast(parts), "place")
    numbers = lambda name: F.explode(F.sequence(F.lit(0).cast("long"), F.col(name) - 1))
    rows = belonging.join(F.broadcast(shape), "cell").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    rows = rows.select("place", "block", numbers("parts").alias("part"), "id", "vector")
    asked = asking.join(F.broadcast(shape.drop("cell").distinct()), "place").withColumn("part", F.pmod(F.xxhash64("question"), F.col("parts")))
    asked = asked.select("place", numbers("blocks").alias("block"), "part", "question", "asked", "bound")
    names = ["question", "id", "distance"]

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        question, row, d = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        if left.num_rows and right.num_rows:
            vectors = _matrix(left.column("vector").combine_chunks(), width)
            questions = _matrix(right.column("asked").combine_chunks(), width)
            bounds = right.column("bound").to_numpy()
            question, row, d = nearest_in_block(vectors, _values(left.column("id")), questions, _values(right.column("question")), bounds, k, skip_own)
        columns = [right.column("question").take(pa.array(question)), left.column("id").take(pa.array(row)), pa.array(d, pa.float64())]
        return pa.Table.from_arrays(columns, names=names)

    schema = StructType(
        [StructField("question", asking.schema["question"].dataType), StructField("id", belonging.schema["id"].dataType), StructField("distance", DoubleType())]
    )
    key = ["place", "block", "part"]
    return rows.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(search, schema)


def _searched_in_place(rows: DataFrame, questions: pa.Table, kind: StructField, k: int, skip_own: bool) -> DataFrame:
    """question, id, distance: of the rows of every task the k nearest to each question."""
    asked = questions.column("asked").combine_chunks()
    width = len(asked[0])
    matrix, names = _matrix(asked, width), _values(questions.column("question"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        bounds = np.full(len(matrix), np.inf)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = _values(batch.column("id"))
            question, row, d = nearest_in_block(_matrix(batch.column("vector"), width), ids, matrix, names, bounds, k, skip_own)
            found = (question, ids[row], d)
            if best:
                found = tuple(np.concatenate(c) for c in zip(best, found))
            order = np.lexsort((np.unique(found[1], return_inverse=True)[1], found[2], found[0]))
            question = found[0][order]
            order = order[np.arange(len(order)) - np.searchsorted(question, question) < k]
            best = tuple(c[order] for c in found)
            last = np.searchsorted(best[0], np.arange(len(matrix)), side="right") - 1
            full = np.bincount(best[0], minlength=len(matrix)) == k
            bounds[full] = best[2][last[full]]
        if best:
            columns = [questions.column("question").take(pa.array(best[0])).combine_chunks(), pa.array(best[1].tolist(), id_type), pa.array(best[2], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["question", "id", "distance"])

    field = rows.schema["id"]
    id_type = to_arrow_type(field.dataType)
    schema = StructType([StructField("question", kind.dataType), StructField("id", field.dataType), StructField("distance", DoubleType())])
    return rows.mapInArrow(search, schema)


def knn_join(
    store: DataFrame, questions: DataFrame, id_column: str, question_column: str, k: int = 10, vector: str = "embedding", skip_own: bool = False
) -> DataFrame:
    """``question_column``, ``rank``, ``id_column``, ``distance``: the k nearest stored rows of every question.

    Exact; equal distances are ordered by id. Both ids must be unique. Rows and questions without a vector take no part;
    a vector of another length is an error. With ``skip_own`` a row with the question's own id is no answer.
    """
    rows = store.where(F.col(vector).isNotNull()).select(F.col(id_column).alias("id"), _plain(store, vector).alias("vector"))
    asked = questions.where(F.col(vector).isNotNull()).select(
        F.col(question_column).alias("question"), _plain(questions, vector).alias("asked"), F.lit(float("inf")).alias("bound")
    )
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toArrow().column("vector").combine_chunks()
    if not len(sample):
        empty = asked.select("question", F.lit(None).cast("int").alias("rank"), F.lit(None).cast(rows.schema["id"].dataType).alias("id"))
        return empty.where("false").withColumn("distance", F.lit(0.0)).toDF(question_column, "rank", id_column, "distance")
    nth = W.partitionBy("question").orderBy("distance", "id")
    ranked = lambda found: found.withColumn("rank", F.row_number().over(nth)).where(F.col("rank") <= k)
    named = lambda found: found.select("question", "rank", "id", "distance").toDF(question_column, "rank", id_column, "distance")
    most = min(FEW, COMPONENTS // max(1, len(sample[0])))
    few = asked.select("question", "asked").limit(most + 1).toArrow() if len(sample) == SAMPLE else None
    if few is not None and 0 < few.num_rows <= most:
        found = named(ranked(_searched_in_place(rows, few, asked.schema["question"], k, skip_own)))
        return F.broadcast(found.orderBy(*first_asc(question_column, "rank")))  # at most k * FEW rows
    pivots = spread_pivots(_matrix(sample, len(sample[0])), min(PIVOTS, -(-len(sample) // PER_PIVOT)))
    belonging = _belonging(rows, pivots)
    cells = measured_cells(belonging, pivots)
    places = shared_places(cells, _block_rows(pivots.shape[1], BLOCK))
    found = _searched(belonging, visits(asked, cells, k + skip_own, True, places), cells, places, k, skip_own)
    first = stored(ranked(found), "nearest")
    # the k-th distance found at home, where the home place has that many
    kth = first.where(F.col("rank") == k).select("question", F.col("distance").alias("bound"))
    bounded = asked.drop("bound").join(kth, "question", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    more = _searched(belonging, visits(bounded, cells, k + skip_own, False, places), cells, places, k, skip_own)
    return named(ranked(first.drop("rank").union(more))).orderBy(*first_asc(question_column, "rank"))
