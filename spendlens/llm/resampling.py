"""Importance resampling of documents towards a target distribution.

Features are runs of one to three words, hashed to buckets. The buckets of all documents and of all target texts are
counted; an array of one gain per bucket scores every feature of a document, and a draw by a hash of the id is added to
the sum (Gumbel top-k, which draws without replacement by weight).

The cutoff among all scores is found by weighted median-of-medians selection: every partition gives the median of the
keys still in question, the median of these weighted by the keys each stands for has at least a quarter of all keys on
either side, and one count decides which side goes. The keys left are written again whenever half of them are gone, so
all rounds together read a few times the keys of the first. Winners are the keys up to the cutoff; they are sorted over
ranges and numbered by the sizes of the ranges before.

A key is (score downwards, doc_id, row number), so no two are equal, and a crowd of equal scores or repeated rows is no
special case. What reaches the driver: two arrays of BUCKETS counts, and per round one median for each partition of the
keys (a few bytes for every part of a hundred megabytes of keys).

Cases: a null or empty text has no features and weight 0. Rows without doc_id are counted in the statistics and come
back with their weight, but have no score and no part in the draw. Repeated rows each take part. Very long texts are
hashed in parts. Extra columns are ignored. Without documents the result is empty; without target texts all gains stem
from the documents alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendlens.llm import common
from spendlens.session import apply_settings

BUCKETS = 10_000
SEED = 42
LEAST_WORDS = 20  # of a document that may be drawn
PERCENT = 5
PART_BYTES = 1 << 20  # of a text hashed at once
FEW = 4096  # keys from which on the driver looks for the cutoff itself

# --- features --------------------------------------------------------------------------------------------------


def _parts(words: bytes) -> Iterator[bytes]:
    """Words between spaces, in parts that cut none."""
    start = 0
    while len(words) - start > PART_BYTES:
        end = words.find(b" ", start + PART_BYTES)
        if end < 0:
            break
        yield words[start:end]
        start = end
    yield words[start:] if start else words


def features(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of a text: number of words, and the CRC-32 of every feature that ends in the part."""
    last: list[bytes] = []  # the last two words before the part
    for part in _parts(text.translate(common.ALNUM_OR_SPACE)):
        new = part.split()
        if not new:
            continue
        words = last + new
        spaced = [b" " + w for w in words]
        # a run's checksum goes on from that of the run without its last word
        one = list(map(crc32, words))
        two = list(map(crc32, spaced[1:], one))
        three = list(map(crc32, spaced[2:], two))
        k = len(last)
        hashes = one[k:] + two[max(k - 1, 0) :] + three[max(k - 2, 0) :]
        yield len(new), np.array(hashes, dtype=np.uint32)
        last = words[-2:]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for text in common.texts(batch.column(0)):
            for _, hashes in features(text):
                counts += np.bincount(hashes % BUCKETS, minlength=BUCKETS)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some], pa.int64())], names=["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all texts per bucket."""
    counts = common.through_arrow(texts.select("text"), _count_batches, "bucket int, n long")
    out = np.zeros(BUCKETS, dtype=np.int64)
    for bucket, n in counts.groupBy("bucket").agg(F.sum("n")).collect():  # at most BUCKETS rows
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket: how much likelier the target has it, in thousandths of a logarithm."""
    all_source, all_target = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * all_source / ((s + 1.0) * all_target))) for s, t in zip(source.tolist(), target.tolist())],
        dtype=np.int64,
    )


# --- scores ----------------------------------------------------------------------------------------------------


def noise(doc_id: int, seed: int = SEED) -> int:
    h = int(sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


SCORED = "doc_id long, n_words long, n_features long, weight long, score long"


def _score_batches(gain: np.ndarray, seed: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), common.texts(batch.column(1))):
            n_words = n_features = weight = 0
            for n, hashes in features(text):
                n_words += n
                n_features += len(hashes)
                weight += int(gain[hashes % BUCKETS].sum())
            rows.append((doc_id, n_words, n_features, weight, None if doc_id is None else weight + noise(doc_id, seed)))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "n_words", "n_features", "weight", "score"]
            )


def scored(docs: DataFrame, target: DataFrame, seed: int = SEED) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight, score."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    return common.through_arrow(docs.select(F.col("doc_id").cast("long"), "text"), partial(_score_batches, gain, seed), SCORED)


# --- selection -------------------------------------------------------------------------------------------------

KEY = ("down", "doc_id", "row")
Key = tuple[int, int, int]


def _below(key: Key) -> Column:
    """Rows whose key is smaller; the first comparison reaches the scan."""
    down, doc, row = (F.col(name) for name in KEY)
    return (down <= key[0]) & ((down < key[0]) | (doc < key[1]) | ((doc == key[1]) & (row < key[2])))


def _above(key: Key) -> Column:
    down, doc, row = (F.col(name) for name in KEY)
    return (down >= key[0]) & ((down > key[0]) | (doc > key[1]) | ((doc == key[1]) & (row > key[2])))


def _median_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and median of a partition's keys."""
    held = [np.stack([batch.column(k).to_numpy() for k in range(3)]) for batch in batches if batch.num_rows]
    if held:
        keys = np.concatenate(held, axis=1)
        middle = np.lexsort(keys[::-1])[(keys.shape[1] - 1) // 2]
        values = [keys.shape[1], *keys[:, middle].tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in values], names=["n", *KEY])


def weighted_median(medians: list[tuple[int, Key]]) -> Key:
    """The first key up to which half of the weight lies."""
    half, seen = sum(n for n, _ in medians) / 2, 0
    for n, key in sorted(medians, key=lambda m: m[1]):
        seen += n
        if seen >= half:
            return key
    raise ValueError("no keys")


def cutoff(keys: DataFrame, k: int, few: int = FEW) -> Key | None:
    """The k-th smallest key of a written table (columns KEY, no two equal); None if k is 0."""
    n = written = keys.count()
    if not 0 < k <= n:
        if k:
            raise ValueError(f"{k} of {n} keys")
        return None
    while n > few:
        medians = keys.mapInArrow(_median_batches, "n long, down long, doc_id long, row long").collect()
        pivot = weighted_median([(r[0], (r[1], r[2], r[3])) for r in medians])
        below = keys.where(_below(pivot)).count()
        if k == below + 1:
            return pivot
        if k <= below:
            keys, n = keys.where(_below(pivot)), below
        else:
            keys, n, k = keys.where(_above(pivot)), n - below - 1, k - below - 1
        if 2 * n <= written:
            keys, written = common.kept(keys), n
    return tuple(sorted(tuple(r) for r in keys.collect())[k - 1])  # at most `few` keys


def _ranked(winners: DataFrame) -> DataFrame:
    """The rows with their rank by KEY: sorted ranges, numbered from the sizes of the ranges before."""
    partitions = int(winners.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = winners.repartitionByRange(partitions, *KEY).sortWithinPartitions(*KEY)
    place = F.monotonically_increasing_id()  # partition above 33 bits of the row's place in it
    rows = common.kept(rows.select("*", F.shiftright(place, 33).alias("range"), place.bitwiseAND((1 << 33) - 1).alias("at")))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    sizes = rows.groupBy("range").agg(F.count("*").alias("n"))
    sizes = sizes.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return rows.join(F.broadcast(sizes), "range").withColumn("rank", F.col("before") + F.col("at") + 1)


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight, score, rank (null if not drawn)."""
    rows = common.kept(scored(docs, target, seed).withColumn("row", F.monotonically_increasing_id()).withColumn("down", -F.col("score")))
    may = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    able = rows.where(may)
    last = cutoff(able.select(*KEY), able.count() * percent // 100)
    names = ["doc_id", "n_words", "n_features", "weight", "score"]
    if last is None:
        return rows.select(*names, F.lit(None).cast("long").alias("rank"))
    drawn = may & ~_above(last)
    rest = rows.where(~F.coalesce(drawn, F.lit(False)))
    return rest.select(*names, F.lit(None).cast("long").alias("rank")).union(_ranked(rows.where(drawn)).select(*names, "rank"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_settings(spark)
    rows = resampled(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")
