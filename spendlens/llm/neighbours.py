"""Approximate nearest neighbours by shifted space-filling curves.

Every vector has a place in each of ORDERS Hilbert orders of random projections (see ``curves``). An order is cut into
ranges of about equal size; a query looks at the range of its own key and at both beside it. Rows travel to their ranges
as codes of one byte a component, and a range hands on the MOST nearest codes of each query. These lists are merged over
all orders, the CANDIDATES best are compared again as the original vectors in double precision, and the nearest stay.

How long a range must be depends on the data, so it is measured: for CALIBRATION vectors the true neighbours are found
among all rows (one pass over blocks), and ranges are as long as TARGET of these neighbours need it to lie within one
range of the query in some order. Spreads, borders of ranges and codes are fitted to a sample of about SAMPLE vectors;
everything is indexed. The tests measure recall against brute force.

Equal vectors are folded before the search: one stands for all, with the smallest of their ids, and one search serves
all queries that are equal. So a vector that a third of all rows share is one row of each order, and ties of copies
come out in the right order.

Cases: rows whose vec_id is null, or whose vector is null, zero, of another length than most, or holds a null or
non-finite component take no part. Rows that repeat a vec_id with an equal vector are one; of different vectors under
one vec_id that with the smallest hash takes part. Ties go to the smaller vec_id. A query has fewer results where there
are fewer candidates, and none as the only vector. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendlens.llm import common
from spendlens.llm.curves import Orders
from spendlens.session import apply_settings

ORDERS = 10
NEAREST = 10
QUERIES = 100  # every row whose vec_id is divisible by this is a query
SAMPLE, CALIBRATION, TARGET = 32_768, 64, 0.95
LEAST_RANGE = 256  # rows
MOST, CANDIDATES = 24, 48  # per query: of a range, and in all
CHUNK = 2048  # rows compared at once


def _valid(table: DataFrame) -> DataFrame:
    """vec_id, vector, h1, h2 of the rows that take part: one vector for each vec_id."""
    rows = table.select(F.col("vec_id").cast("long"), F.col("embedding").alias("vector")).where("vec_id IS NOT NULL AND vector IS NOT NULL")
    # a difference to itself is zero for finite numbers only
    finite = F.forall("vector", lambda x: x.isNotNull() & F.coalesce(x - x == 0, F.lit(False)))
    rows = rows.where(finite & F.exists("vector", lambda x: x != 0))
    width = rows.agg(F.mode(F.size("vector"), True).alias("width"))
    rows = rows.where(F.size("vector") == width.scalar())
    rows = rows.select("*", F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2"))
    hashes = F.struct("h1", "h2")
    several = rows.groupBy("vec_id").agg(F.min(hashes).alias("first"), F.max(hashes).alias("last")).where("first <> last")
    rows = rows.join(several.select("vec_id", "first"), "vec_id", "left")
    return rows.where(F.col("first").isNull() | (F.col("first") == hashes)).drop("first")


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches with their ids and vectors (columns vec_id and vector)."""
    for batch in batches:
        if batch.num_rows:
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            yield batch, batch.column("vec_id").to_numpy(), flat.reshape(batch.num_rows, -1)


def _nearest(ids: np.ndarray, distances: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of distances (queries x candidates) the k smallest, with the candidates' ids."""
    if distances.shape[1] > k:
        best = np.argpartition(distances, k - 1, axis=1)[:, :k]
        return np.take_along_axis(ids, best, axis=1), np.take_along_axis(distances, best, axis=1)
    return ids, distances


def _squares(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.maximum((queries**2).sum(axis=1)[:, None] + (rows**2).sum(axis=1)[None] - 2 * queries @ rows.T, 0)


# --- calibration -----------------------------------------------------------------------------------------------


def _true_batches(asked: np.ndarray, vectors: np.ndarray, orders: Orders, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nearest rows of a task to each asked vector, with their keys."""
    best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for _, ids, rows in _arrays(batches):
        for a in range(0, len(ids), CHUNK):
            distances = _squares(vectors, rows[a : a + CHUNK])
            distances[asked[:, None] == ids[None, a : a + CHUNK]] = np.inf
            at, near = _nearest(np.broadcast_to(np.arange(a, a + distances.shape[1]), distances.shape), distances, NEAREST)
            use, where = np.unique(at, return_inverse=True)
            keys = orders.keys(ids[use], rows[use]).T[where.reshape(at.shape)]
            best.append((ids[at], near, keys))
            if len(best) > 8:
                best = [_joined_best(best)]
    if best:
        ids, near, keys = _joined_best(best)
        n = ids.shape[1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(asked, n)), pa.array(ids.ravel()), pa.array(near.ravel()), pa.array(keys.reshape(-1, keys.shape[2]).tolist(), pa.list_(pa.int64()))],
            names=["asked", "vec_id", "distance", "keys"],
        )


def _joined_best(best: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, near, keys = (np.concatenate(part, axis=1) for part in zip(*best))
    order = np.lexsort((ids, near))[:, :NEAREST]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1), np.take_along_axis(keys, order[:, :, None], 1)


def _best_of(rows: DataFrame, key: str, k: int, *order: str) -> DataFrame:
    """The k first rows of each key."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("place", place).where(F.col("place") <= k)


def ranges_per_order(rows: DataFrame, n: int, ids: np.ndarray, vectors: np.ndarray, orders: Orders, sorted_keys: np.ndarray, target: float = TARGET) -> int:
    """Into how many ranges the orders may be cut, from the true neighbours of CALIBRATION vectors of the sample."""
    some = np.argsort(common.mix(ids.view(np.uint64)))[:CALIBRATION]
    found = rows.mapInArrow(
        partial(_true_batches, ids[some], vectors[some], orders), "asked long, vec_id long, distance double, keys array<long>"
    ).where("distance < double('Infinity')")
    nearest = _best_of(found.distinct(), "asked", NEAREST, "distance", "vec_id").select("asked", "keys").collect()  # CALIBRATION * NEAREST rows
    if not nearest:
        return 1

    def fractions(keys: np.ndarray) -> np.ndarray:  # of an order before each key
        return np.stack([np.searchsorted(s, k) / len(s) for s, k in zip(sorted_keys, keys)])

    own = dict(zip(ids[some].tolist(), fractions(orders.keys(ids[some], vectors[some])).T))
    theirs = fractions(np.array([r[1] for r in nearest], dtype=np.int64).T).T
    apart = np.abs(theirs - np.stack([own[r[0]] for r in nearest])).min(axis=1)
    needed = max(float(np.quantile(apart, target)), 8 / sorted_keys.shape[1], LEAST_RANGE / n)
    return max(1, int(1 / needed))


# --- search ----------------------------------------------------------------------------------------------------

DEALT = "place long, search boolean, vec_id long, code binary"


def _dealt_batches(orders: Orders, borders: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as codes in their range of each order, and searches as vectors in three ranges."""
    width = borders.shape[1] + 1
    for batch, ids, vectors in _arrays(batches):
        codes = orders.encode(vectors)
        searches = np.flatnonzero(batch.column("search").to_numpy(zero_copy_only=False))
        wanted = [vectors[i].astype(np.float32).tobytes() for i in searches]
        row_codes = [code.tobytes() for code in codes]
        for k, keys in enumerate(orders.keys(ids, vectors)):
            at = np.searchsorted(borders[k], keys, side="right")
            yield _dealt(k * width + at, False, ids, row_codes)
            for beside in (-1, 0, 1):
                there = at[searches] + beside
                inside = np.flatnonzero((there >= 0) & (there < width))
                if len(inside):
                    yield _dealt(k * width + there[inside], True, ids[searches[inside]], [wanted[i] for i in inside])


def _dealt(place: np.ndarray, search: bool, ids: np.ndarray, codes: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(place, pa.int64()), pa.array(np.full(len(ids), search)), pa.array(ids, pa.int64()), pa.array(codes, pa.binary())],
        names=["place", "search", "vec_id", "code"],
    )


FOUND = "query long, vec_id long, distance float"


def _found_batches(orders: Orders, most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nearest codes of every search within its range; searches come first in a range."""
    place, asked, vectors, best = None, [], [], None

    def out() -> Iterator[pa.RecordBatch]:
        if best is not None:
            ids, near = best
            keep = np.isfinite(near)
            query = np.broadcast_to(np.array(asked)[:, None], ids.shape)[keep]
            yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(ids[keep], pa.int64()), pa.array(near[keep], pa.float32())], names=["query", "vec_id", "distance"])

    for batch in batches:
        places, search = batch.column("place").to_numpy(), batch.column("search").to_numpy(zero_copy_only=False)
        ids, codes = batch.column("vec_id").to_numpy(), batch.column("code")
        edges = np.flatnonzero((places[1:] != places[:-1]) | (search[1:] != search[:-1])) + 1
        for a, b in zip([0, *edges], [*edges, len(places)]):
            if a == b:
                continue
            if places[a] != place:
                yield from out()
                place, asked, vectors, best = places[a], [], [], None
            if search[a]:
                asked.extend(ids[a:b].tolist())
                vectors.extend(np.frombuffer(v.as_buffer(), np.float32) for v in codes.slice(a, b - a))
            elif asked:
                matrix = np.stack(vectors)
                for c in range(a, b, CHUNK):
                    d = min(c + CHUNK, b)
                    raw = np.frombuffer(b"".join(codes.slice(c, d - c).to_pylist()), np.uint8).reshape(d - c, -1)
                    near = _squares(matrix, orders.decode(raw)).astype(np.float32)
                    own = np.broadcast_to(ids[c:d], near.shape)
                    if best is not None:
                        own, near = np.concatenate([best[0], own], axis=1), np.concatenate([best[1], near], axis=1)
                    best = _nearest(own, near, most)
    yield from out()


def _sample(rows: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of about SAMPLE rows."""
    some = rows.where(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(max(1, -(-n // SAMPLE)))) == 0).select("vec_id", "vector").toArrow()
    vectors = some.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return some.column("vec_id").to_numpy(), vectors.reshape(some.num_rows, -1)


def _distance(a: str, b: str) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def nearest(table: DataFrame, every: int = QUERIES, k: int = NEAREST, target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose vec_id is divisible by ``every``."""
    spark = table.sparkSession
    valid = common.kept(_valid(table))
    crowds = valid.groupBy("h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.max(F.col("vec_id") % every == 0).alias("search")
    )
    crowds = common.kept(crowds.where("n > 1").drop("n"))
    named = valid.join(crowds, ["h1", "h2"], "left")
    alone = F.col("rep").isNull()
    rows = common.kept(
        named.where(alone | (F.col("rep") == F.col("vec_id"))).select("vec_id", "vector", F.coalesce("search", F.col("vec_id") % every == 0).alias("search"))
    )
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    ids, vectors = _sample(rows, n)
    orders = Orders.fitted(vectors, ORDERS)
    sorted_keys = np.sort(orders.keys(ids, vectors), axis=1)
    width = ranges_per_order(rows, n, ids, vectors, orders, sorted_keys, target)
    borders = sorted_keys[:, [len(ids) * i // width for i in range(1, width)]]

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = common.through_arrow(rows, partial(_dealt_batches, orders, borders), DEALT)
    dealt = dealt.repartition(partitions, "place").sortWithinPartitions("place", F.desc("search"))
    found = dealt.mapInArrow(partial(_found_batches, orders, MOST), FOUND)
    found = found.groupBy("query", "vec_id").agg(F.min("distance").alias("distance"))
    pairs = _best_of(found, "query", CANDIDATES, "distance", "vec_id").select("query", "vec_id")
    pairs = common.kept(pairs)

    mine = rows.where("search").select(F.col("vec_id").alias("query"), F.col("vector").alias("mine")).dropDuplicates(["query"])
    theirs = pairs.join(rows.select("vec_id", "vector").dropDuplicates(["vec_id"]), "vec_id")
    scored = theirs.join(mine, "query").select("query", "vec_id", _distance("mine", "vector").alias("score"))
    scored = common.kept(_best_of(scored, "query", k + 1, "score", "vec_id").drop("place"))

    # copies: the smallest ids of each class, and all queries of a class
    members = named.where(~alone).select("rep", "vec_id").distinct()
    firsts = _best_of(members, "rep", k + 1, "vec_id").select("rep", F.col("vec_id").alias("member"))
    classes = scored.withColumnRenamed("vec_id", "rep").join(firsts, "rep", "left")
    lists = _best_of(classes.select("query", F.coalesce("member", "rep").alias("vec_id"), "score"), "query", k + 1, "score", "vec_id")
    lists = lists.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("near"))  # k + 1 each
    asking = named.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.coalesce("rep", "vec_id").alias("query")).distinct()
    others = asking.join(lists, "query").select("query_id", F.filter("near", lambda x: x["vec_id"] != F.col("query_id")).alias("near"))
    ranked = others.select("query_id", F.posexplode(F.slice("near", 1, k)).alias("at", "hit"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_settings(spark)
    return nearest(common.read(spark, sf_dir, "embeddings"))
