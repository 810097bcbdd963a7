"""Helpers shared by the operators: rows through Arrow, kept intermediate tables, words and their hashes.

Words are bytes of UTF-8: ``bytes.lower`` folds A-Z only, and every byte from 0x80 on belongs to a word, so
classes of ASCII separators work on bytes as they do on code points.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SLICE_BYTES = 1 << 20  # text handled at once by the vectorised steps
LONG_BYTES = 4 << 20  # a text beyond this is hashed in parts
BATCH_BYTES = 8 << 20  # of one Arrow batch

# separators of the two word classes the operators use
_SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_ALNUM = b"0123456789abcdefghijklmnopqrstuvwxyz"
SPACED = np.ones(256, dtype=bool)
SPACED[list(_SPACES)] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[list(_ALNUM)] = True
ALNUM[128:] = True
FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
ALNUM_OR_SPACE = bytes(FOLD[b] if ALNUM[FOLD[b]] else 32 for b in range(256))

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def kept(df: DataFrame) -> DataFrame:
    """The rows, computed once: a table in the folder that executors share, whose size Spark knows.

    What comes after reads the table, so a lost executor costs no more than its own tasks.
    """
    folder = shared_folder(df.sparkSession, "kept")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="kept-")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _local_folder()
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def set_apart(docs: DataFrame, used: list[str]) -> tuple[DataFrame, list[Column]]:
    """The rows with all columns but the ``used`` ones under names no operator uses, and the columns as they were."""
    names = {c: c if c in used else f"given {i}" for i, c in enumerate(docs.columns)}

    def quoted(name: str) -> Column:
        return F.col("`" + name.replace("`", "``") + "`")

    return docs.select(*[quoted(c).alias(n) for c, n in names.items()]), [quoted(n).alias(c) for c, n in names.items()]


def through_arrow(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str
) -> DataFrame:
    """``mapInArrow`` over batches of bounded bytes."""
    return df.mapInArrow(lambda batches: function(_small(batches)), schema)


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.num_rows
        step = max(1, min(rows, int(rows * BATCH_BYTES / max(batch.nbytes, 1))))
        for start in range(0, rows, step):
            yield batch.slice(start, step)


def texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 of each text; empty for null."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def slices(values: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that together stay below ``limit`` bytes (a longer text alone)."""
    start, size = 0, 0
    for i, value in enumerate(values):
        if i > start and size + len(value) > limit:
            yield start, i
            start, size = i, 0
        size += len(value)
    if values:
        yield start, len(values)


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that all bits depend on all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, grown as needed."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers))
        inverse = np.uint64(pow(int(_BASE), -1, 2**64))
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE)]), dtype=np.uint64)
            _inverses = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, inverse)]), dtype=np.uint64)
    return _powers[:n], _inverses[:n]


def word_hashes(values: list[bytes], inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts, and where each text's words start (one more than texts).

    ``inside`` says which folded bytes belong to words. A word's hash is a polynomial of its bytes, taken
    from running sums, so the work is a few array operations for any number of words.
    """
    if len(values) == 1 and len(values[0]) > LONG_BYTES and len(parts := list(_parts(values[0], inside))) > 1:
        hashes = np.concatenate([word_hashes([part], inside)[0] for part in parts])
        return hashes, np.asarray([0, len(hashes)])
    blob = b"\x20".join([*values, b""]).translate(FOLD)
    if not blob:
        return np.empty(0, np.uint64), np.zeros(len(values) + 1, np.int64)
    raw = np.frombuffer(blob, dtype=np.uint8)
    word = inside[raw]
    ends = np.cumsum([len(v) + 1 for v in values])
    word[ends - 1] = False  # a separator between texts
    edge = np.diff(word.astype(np.int8), prepend=0, append=0)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    powers, inverses = _power_tables(len(raw) + 1)
    sums = np.empty(len(raw) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[raw] * powers[: len(raw)], out=sums[1:])
    hashes = mix((sums[last] - sums[first]) * inverses[first])
    return hashes, np.concatenate([[0], np.searchsorted(first, ends)])


def _parts(value: bytes, inside: np.ndarray) -> Iterator[bytes]:
    """A long text in parts of about LONG_BYTES / 2 that cut no word (a longer word stays whole)."""
    start = 0
    while start < len(value):
        end = start + LONG_BYTES // 2
        while end < len(value) and inside[FOLD[value[end]]]:
            end += 1
        yield value[start:end]
        start = end


def shingles(hashes: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within each text; a shorter text is one run. Not yet distinct."""
    counts = np.diff(starts)
    runs = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    out_starts = np.concatenate([[0], np.cumsum(runs)])
    total = np.zeros(len(hashes) + size, dtype=np.uint64)
    for k in range(size):  # the k-th word of every run, as if all texts were one
        shifted = hashes[k:] * np.uint64(2 * k + 3)
        total[: len(shifted)] = mix(total[: len(shifted)] + shifted)
    out = np.empty(out_starts[-1], dtype=np.uint64)
    long = counts >= size
    owner = np.repeat(np.arange(len(counts)), runs)
    within = np.arange(len(out)) - out_starts[owner]
    full = long[owner]
    out[full] = total[starts[owner[full]] + within[full]]
    for i in np.flatnonzero((counts > 0) & ~long):
        value = np.full(1, counts[i], dtype=np.uint64)
        for k in range(starts[i], starts[i + 1]):
            value = mix(value + hashes[k : k + 1])
        out[out_starts[i]] = value[0]
    return out, out_starts


def ascii_folded(column: str):
    """The text with A-Z in lower case, empty for null."""
    return F.translate(F.coalesce(F.col(column), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
