"""SimHash fingerprints and the search for close ones.

The terms of a text are its runs of three words, and its runs of four bytes; a term's weight is one plus the logarithm
of its count. Runs of bytes help texts of few words, where runs of words are too few to compare: their weight fades with
every word and is gone at FEW_WORDS words, so texts of like length have like terms. Every term's hash votes with its
weight on each of the BITS bits, and a bit is set where the votes are positive. Likeness of two
fingerprints is the cosine that their share of different bits estimates, and 0 from a right angle on.

Neighbours within a Hamming radius come from permuted block tables: the bits are cut into ``radius + keys`` blocks, and
two fingerprints that differ in at most ``radius`` bits agree in at least ``keys`` of them. Each choice of ``keys``
blocks is a table that is joined on these blocks; pairs are then checked on all bits. Equal fingerprints are folded
into one class first, so copies are never paired with each other.

Cases: null and empty texts, and texts without words, have the fingerprint of no votes (all bits 0) and are alike only
to each other. Rows without doc_id stand after all others. Repeated rows follow each other in order of their text.
Extra columns are ignored. An empty table gives an empty result; a single row is its own next document.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendlens.llm import common
from spendlens.session import apply_settings

BITS = 128
TERM_WORDS = 3
FEW_WORDS = 32
RADIUS, KEYS = 3, 2
BUCKET = 128  # ids in one bucket of the order


def fingerprints(values: list[bytes]) -> np.ndarray:
    """One row of BITS / 8 bytes for each text."""
    out = np.zeros((len(values), BITS // 8), dtype=np.uint8)
    words, starts = common.word_hashes(values, common.ALNUM)
    terms, at = common.shingles(words, starts, TERM_WORDS)
    for i, value in enumerate(values):
        if at[i] < at[i + 1]:
            votes, n_words = _votes(terms[at[i] : at[i + 1]]), int(starts[i + 1] - starts[i])
            if n_words < FEW_WORDS:
                votes += (1 - n_words / FEW_WORDS) * _votes(_byte_terms(value))
            out[i] = np.packbits(votes > 0)
    return out


def _byte_terms(value: bytes) -> np.ndarray:
    raw = np.frombuffer(value.translate(common.FOLD), np.uint8).astype(np.uint64)
    return common.mix(sum(raw[k : len(raw) - 3 + k] << np.uint64(8 * k) for k in range(4)) + np.uint64(1) if len(raw) > 3 else raw[:0])


def _votes(terms: np.ndarray) -> np.ndarray:
    distinct, counts = np.unique(terms, return_counts=True)
    weights = (1 + np.log(counts)).astype(np.float32)
    votes = np.zeros(BITS, dtype=np.float64)
    for start in range(0, len(distinct), 65_536):  # bounded memory for long texts
        part = distinct[start : start + 65_536]
        halves = [common.mix(part ^ np.uint64(k + 1)) for k in range(BITS // 64)]
        bits = np.unpackbits(np.stack(halves, axis=1).view(np.uint8), axis=1)
        weight = weights[start : start + 65_536]
        votes += 2.0 * (weight @ bits.astype(np.float32)) - float(weight.sum(dtype=np.float64))
    return votes


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine of the angle that the share of different bits stands for; 0 from a right angle on."""
    if not a.any() or not b.any():
        return float(not a.any() and not b.any())
    different = int(np.unpackbits(a ^ b).sum())
    return max(0.0, math.cos(math.pi * different / BITS))


OUT = (
    "kind int, bucket long, doc_id long, text string, n_chars long, edited_sha256 string, "
    "fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)
RESOLVED, FIRST, LAST = 0, 1, 2


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as many first characters of the next one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _compare(rows: list[tuple[int | None, str, str]]) -> list[dict]:
    """Results for (doc_id, text, next text)."""
    changed = [edited(text, following).encode() for _, text, following in rows]
    own = fingerprints([text.encode() for _, text, _ in rows])
    after = fingerprints([following.encode() for _, _, following in rows])
    other = fingerprints(changed)
    return [
        {
            "kind": RESOLVED, "bucket": None, "doc_id": doc_id, "text": None, "n_chars": len(text),
            "edited_sha256": hashlib.sha256(changed[i]).hexdigest(), "fingerprint": own[i].tobytes().hex(),
            "edited_fingerprint": other[i].tobytes().hex(), "near_edited": likeness(own[i], other[i]),
            "near_next": likeness(own[i], after[i]),
        }
        for i, (doc_id, text, _) in enumerate(rows)
    ]


_ARROW = pa.schema([
    ("kind", pa.int32()), ("bucket", pa.int64()), ("doc_id", pa.int64()), ("text", pa.string()), ("n_chars", pa.int64()),
    ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()),
])


def _open_row(kind: int, bucket: int, doc_id: int | None, text: str) -> dict:
    return dict.fromkeys(_ARROW.names) | {"kind": kind, "bucket": bucket, "doc_id": doc_id, "text": text}


def _bucket_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours within a bucket are compared; its first and last text come out for the neighbouring buckets."""
    held: tuple[int, int | None, str] | None = None
    pairs: list[tuple[int | None, str, str]] = []
    ends: list[dict] = []
    size = 0
    for batch in batches:
        for bucket, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            text = text or ""
            if held is None or held[0] != bucket:
                if held is not None:
                    ends.append(_open_row(LAST, *held))
                ends.append(_open_row(FIRST, bucket, doc_id, text))
            else:
                pairs.append((held[1], held[2], text))
                size += len(held[2])
            held = (bucket, doc_id, text)
            if size > common.SLICE_BYTES:
                yield pa.RecordBatch.from_pylist(_compare(pairs) + ends, schema=_ARROW)
                pairs, ends, size = [], [], 0
    if held is not None:
        ends.append(_open_row(LAST, *held))
        yield pa.RecordBatch.from_pylist(_compare(pairs) + ends, schema=_ARROW)


def _pair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
        yield pa.RecordBatch.from_pylist(_compare([(d, t or "", n or "") for d, t, n in rows]), schema=_ARROW)


def next_buckets(buckets: DataFrame) -> DataFrame:
    """For each bucket that has rows the next lower one; the highest after the lowest."""
    groups = buckets.select("bucket", F.floor(F.col("bucket") / BUCKET).alias("g"))
    within = groups.withColumn("after", F.lead("bucket").over(Window.partitionBy("g").orderBy(F.desc("bucket"))))
    tops = groups.groupBy("g").agg(F.max("bucket").alias("top"))
    order = Window.orderBy(F.desc("g"))  # one row for BUCKET * BUCKET ids
    tops = tops.select("g", F.lead("top").over(order).alias("below"), F.first("top").over(order).alias("highest"))
    return within.join(tops, "g").select("bucket", F.coalesce("after", "below", "highest").alias("after"))


def compared(docs: DataFrame) -> DataFrame:
    """Every row with the digest of its edited text, both fingerprints, and their likeness and that of the next row."""
    lowest = F.lit(-(2**62))  # the bucket of rows without doc_id
    bucket = F.coalesce(F.floor(F.col("doc_id") / BUCKET), lowest)
    rows = docs.select(bucket.alias("bucket"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(partitions, "bucket").sortWithinPartitions("bucket", F.desc_nulls_last("doc_id"), "text")
    done = common.kept(common.through_arrow(rows, _bucket_batches, OUT))
    firsts = done.where(F.col("kind") == FIRST).select(F.col("bucket").alias("after"), F.col("text").alias("following"))
    lasts = done.where(F.col("kind") == LAST).select("bucket", "doc_id", "text")
    order = next_buckets(lasts.select("bucket"))
    seams = lasts.join(order, "bucket").join(firsts, "after").select("doc_id", "text", "following")
    joined = common.through_arrow(seams, _pair_batches, OUT)
    return done.where(F.col("kind") == RESOLVED).union(joined).drop("kind", "bucket", "text")


def neighbours(prints: DataFrame, radius: int = RADIUS, keys: int = KEYS) -> tuple[DataFrame, DataFrame]:
    """All pairs of different fingerprints within ``radius`` bits, and the class of each row.

    ``prints`` has doc_id and fingerprint (hex). Gives links (a, b: the smallest doc_id of two classes, distance) and
    members (doc_id, fingerprint, class_id). A class is all rows of one fingerprint.
    """
    members = prints.where("fingerprint IS NOT NULL AND doc_id IS NOT NULL")
    classes = common.kept(members.groupBy("fingerprint").agg(F.min("doc_id").alias("class_id")))
    digits, blocks = BITS // 4, radius + keys
    cuts = [digits * i // blocks for i in range(blocks + 1)]
    part = [F.substring("fingerprint", cuts[i] + 1, cuts[i + 1] - cuts[i]) for i in range(blocks)]
    tables = [F.concat(F.lit(f"{n}:"), *(part[i] for i in chosen)) for n, chosen in enumerate(combinations(range(blocks), keys))]
    keyed = classes.select("class_id", "fingerprint", F.explode(F.array(*tables)).alias("key"))
    a = keyed.select("key", F.col("class_id").alias("a"), F.col("fingerprint").alias("fa"))
    b = keyed.select("key", F.col("class_id").alias("b"), F.col("fingerprint").alias("fb"))
    words = [(16 * i + 1, 16) for i in range(BITS // 64)]

    def word(name: str, at: int, size: int) -> F.Column:
        return F.conv(F.substring(name, at, size), 16, -10).cast("long")

    distance = sum((F.bit_count(word("fa", *w).bitwiseXOR(word("fb", *w))) for w in words), F.lit(0))
    links = a.join(b, "key").where("a < b").withColumn("distance", distance).where(F.col("distance") <= radius)
    return links.select("a", "b", "distance").distinct(), members.join(classes, "fingerprint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_settings(spark)
    return compared(common.read(spark, sf_dir, "documents"))
