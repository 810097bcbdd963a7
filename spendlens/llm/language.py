"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

A text's letters are folded to lower case, everything else is a gap, and its runs of one to three characters are hashed
to FEATURES numbers. Document frequencies come from all rows that may be learnt from. Weights are fitted by
follow-the-regularised-leader with per-coordinate rates and an elastic net, which leaves most of them at 0, on at most
LEARN_ROWS rows (about PER_LANGUAGE of each language, the first by a hash of doc_id) in one task; a fifth of these rows
fits the temperature of the probabilities instead. Rows with crc32(doc_id) mod 3 = 1 are never learnt from.

Cases: a null text or one without a letter is ``und`` with score 1. Rows without doc_id are predicted and neither
learnt from nor held out. Repeated rows are predicted each on its own. Without rows to learn from everything is
``und`` with score 0. Extra columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm import common
from spendlens.session import apply_settings

FEATURES = 1 << 16
LENGTHS = (1, 2, 3)
FOLDS, HELD_OUT = 3, 1
LEARN_ROWS, PER_LANGUAGE = 8_000, 1_500
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.01, 0.01  # rate, its smoothing, and the elastic net
UNKNOWN = "und"
CHUNK = 1 << 20  # characters of a long text counted at once


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def counts(text: str | None) -> np.ndarray | None:
    """Number of n-grams per feature; None without a letter."""
    if not text:
        return None
    total, any_letter = None, False
    for start in range(0, len(text), CHUNK):
        part = text[max(0, start - 2) : start + CHUNK].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        inside = _letters()[codes]
        any_letter = any_letter or bool(inside.any())
        codes = np.where(inside, codes, 32).astype(np.uint64)
        gap = (codes[1:] == 32) & (codes[:-1] == 32)
        codes = np.concatenate([codes[:1], codes[1:][~gap]])
        codes = np.concatenate([[32], codes, [32]]).astype(np.uint64)
        grams = []
        for n in LENGTHS:
            h = np.full(max(len(codes) - n + 1, 0), n, dtype=np.uint64)
            for k in range(n):
                h = (h + codes[k : len(codes) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            grams.append((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48))
        found = np.bincount(np.concatenate(grams).astype(np.int64), minlength=FEATURES)
        total = found if total is None else total + found
    return total if any_letter else None


def weighted(found: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and their TF-IDF values, of length 1 together."""
    places = np.flatnonzero(found)
    values = np.log1p(found[places]) * idf[places]
    return places, (values / max(float(np.sqrt(values @ values)), 1e-12)).astype(np.float64)


def _frequency_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of all texts of a task together: how many there are, and how many have each feature."""
    n, total = 0, np.zeros(FEATURES, dtype=np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            found = counts(text)
            if found is not None:
                n += 1
                total += found > 0
    places = np.flatnonzero(total)
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-1], places]), pa.int64()), pa.array(np.concatenate([[n], total[places]]), pa.int64())],
            names=["feature", "n"],
        )


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """IDF of every feature over all texts; FEATURES numbers reach the driver."""
    rows = common.through_arrow(texts, _frequency_batches, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    found = {r[0]: r[1] for r in rows.toLocalIterator()}
    n = found.pop(-1, 0)
    frequency = np.zeros(FEATURES)
    frequency[list(found)] = list(found.values())
    return np.log((1 + n) / (1 + frequency)) + 1


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(examples: list[tuple[np.ndarray, np.ndarray, int]], classes: int, seed: int = 5) -> tuple[np.ndarray, float]:
    """Weights (features and a bias by class) and the temperature of its probabilities."""
    order = np.random.default_rng(seed).permutation(len(examples))
    aside = order[: len(order) // 5]
    z, n = np.zeros((FEATURES + 1, classes)), np.zeros((FEATURES + 1, classes))

    def weights(rows: np.ndarray) -> np.ndarray:
        zr, rate = z[rows], (BETA + np.sqrt(n[rows])) / ALPHA
        return np.where(np.abs(zr) <= L1, 0.0, -(zr - np.sign(zr) * L1) / (rate + L2))

    for _ in range(EPOCHS):
        for i in order[len(aside) :]:
            places, values, label = examples[i]
            rows, x = np.append(places, FEATURES), np.append(values, 1.0)
            w = weights(rows)
            error = softmax(x @ w)
            error[label] -= 1
            g = x[:, None] * error[None, :]
            step = (np.sqrt(n[rows] + g * g) - np.sqrt(n[rows])) / ALPHA
            z[rows] += g - step * w
            n[rows] += g * g
    final = weights(np.arange(FEATURES + 1))
    if not len(aside):
        return final, 1.0
    logits = np.stack([examples[i][1] @ final[examples[i][0]] + final[FEATURES] for i in aside])
    labels = np.asarray([examples[i][2] for i in aside])
    grid = np.exp(np.linspace(-2, 2, 81))
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return final, float(grid[int(np.argmin(loss))])


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray, float]:
    """Languages, IDF, weights and temperature."""
    spark = docs.sparkSession
    rows = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").where(~held_out())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().toLocalIterator()}
    idf = inverse_frequencies(rows.select("text"))
    languages = sorted(sizes)
    if not languages:
        return [], idf, np.zeros((FEATURES + 1, 0)), 1.0
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    rate = F.coalesce(*(F.when(F.col("lang") == k, min(1.0, PER_LANGUAGE / n)) for k, n in sizes.items()))
    sample = rows.select("doc_id", "text", "lang").where(draw < rate).orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(LEARN_ROWS)
    held = spark.sparkContext.broadcast(idf)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            for text, lang in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                found = counts(text)
                if found is not None:
                    examples.append((*weighted(found, held.value), languages.index(lang)))
        weights, temperature = fit(examples, len(languages))
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.tobytes()], pa.binary()), pa.array([temperature])], names=["weights", "temperature"]
        )

    model = common.through_arrow(sample.coalesce(1), train, "weights binary, temperature double").first()
    weights = np.frombuffer(bytes(model["weights"])).reshape(FEATURES + 1, len(languages))
    return languages, idf, weights, model["temperature"]


PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray, float]) -> DataFrame:
    """doc_id, held_out, lang_pred and the probability of the prediction for every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def one(text: str | None) -> tuple[str, float]:
        languages, idf, weights, temperature = held.value
        found = counts(text)
        if found is None:
            return UNKNOWN, 1.0
        if not languages:
            return UNKNOWN, 0.0
        places, values = weighted(found, idf)
        p = softmax((values @ weights[places] + weights[FEATURES]) / temperature)
        best = int(np.argmax(p))
        return languages[best], float(p[best])

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return common.through_arrow(docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text"), batches_of, PREDICTED)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_settings(spark)
    docs = common.read(spark, sf_dir, "documents")
    return predict(docs, learn(docs))
