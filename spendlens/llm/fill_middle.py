"""Fill-in-the-middle: texts cut at two units and put together as prefix, suffix and middle.

A unit is a run of A-Z and a-z or one other code point. A text's UTF-8 lies in fixed blocks; a Fenwick tree over the
blocks holds how many units and how many code points start in each. A cut after so many units goes down the tree by
binary lifting to the block where the next unit starts, and is found among the units of that block alone. Texts are
looked at in parts of whole blocks, so beside a text itself and its output only two counts per block are held.

Where the cuts fall, whether a text stays as it is, and which order it gets is fixed by a hash of its id and a seed, so
a task that runs again gives the same rows. ``restored`` is the way back, from output and form alone, in DataFrame
functions. There is no shuffle.

Cases: a null text is an empty one. Empty texts and texts that contain a marker stay plain. A null doc_id hashes like an
empty one. Repeated rows come back as often, each alike. Extra columns are ignored. An empty table gives no rows. A cut
may fall at either end, so each of the three parts may be empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm import common
from spendlens.session import apply_settings

BLOCK = 1024  # bytes
PART = 1 << 20  # bytes looked at together, whole blocks
SEED = 1
FORMED, SPM = 90, 20  # of 100: texts that are cut, and of these those that begin with the suffix
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LEAD = np.ones(256, dtype=bool)
_LEAD[0x80:0xC0] = False  # bytes that go on with a code point


def _starts(raw: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes from first to last start a unit, and which a code point."""
    letter = _LETTER[raw[first:last]]
    lead = _LEAD[raw[first:last]]
    before = np.empty(len(letter), dtype=bool)
    before[1:] = letter[:-1]
    before[:1] = first > 0 and _LETTER[raw[first - 1]]
    return lead & ~(letter & before), lead


class Units:
    """The units of a text: their number, and the place of a cut after any number of them."""

    def __init__(self, text: bytes, block: int = BLOCK) -> None:
        self.raw, self.block = np.frombuffer(text, np.uint8), block
        size = -(-len(text) // block)
        # tree[i] sums the blocks above i - (i & -i) up to i, numbered from 1
        self.tree = np.zeros((size + 1, 2), dtype=np.int64)
        step = max(1, PART // block) * block
        for first in range(0, len(text), step):
            last = min(first + step, len(text))
            edges = np.arange(0, last - first, block)
            at = first // block + 1
            for k, marks in enumerate(_starts(self.raw, first, last)):
                self.tree[at : at + len(edges), k] = np.add.reduceat(marks.astype(np.int64), edges)
        self.n, self.n_chars = self.tree.sum(axis=0).tolist()
        sums = np.cumsum(self.tree, axis=0)
        place = np.arange(1, size + 1)
        self.tree[1:] = sums[1:] - sums[place - (place & -place)]

    def cut(self, after: int) -> tuple[int, int]:
        """Byte and code point where the text's first ``after`` units end."""
        if after >= self.n:
            return len(self.raw), self.n_chars
        size, done, units, chars = len(self.tree) - 1, 0, 0, 0
        step = 1 << max(size.bit_length() - 1, 0)
        while step:  # blocks before the one where the unit ``after`` starts
            there = done + step
            if there <= size and units + self.tree[there, 0] <= after:
                done, units, chars = there, units + self.tree[there, 0], chars + self.tree[there, 1]
            step >>= 1
        first = done * self.block
        starts, leads = _starts(self.raw, first, min(first + self.block, len(self.raw)))
        at = int(np.flatnonzero(starts)[after - units])
        return first + at, int(chars + np.count_nonzero(leads[:at]))


def transformed(doc_id: int | None, text: bytes, seed: int = SEED) -> tuple[int, str, int | None, int | None, bytes]:
    """Number of units, form, code points of prefix and middle, and the output."""
    units = Units(text)
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or h3 % 100 >= FORMED or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return units.n, "plain", None, None, text
    a, b = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
    (byte_a, char_a), (byte_b, char_b) = units.cut(a), units.cut(b)
    view = memoryview(text)
    prefix, middle, suffix = view[:byte_a], view[byte_a:byte_b], view[byte_b:]
    if h4 % 100 < SPM:
        form, parts = "spm", (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
    else:
        form, parts = "psm", (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
    return units.n, form, char_a, char_b - char_a, b"".join(parts)


TRANSFORMED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_ARROW = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
_NAMES = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]


def _batches(seed: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, values = batch.column(0).to_pylist(), common.texts(batch.column(1))
        for first, last in common.slices(values):
            rows = [(ids[i], *transformed(ids[i], values[i], seed)) for i in range(first, last)]
            *plain, outputs = zip(*rows)
            columns = [pa.array(c, t) for c, t in zip(plain, _ARROW)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(outputs, pa.binary()).cast(pa.string())], names=_NAMES)


def fill_in_middle(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Per row: doc_id, n units, form, prefix_chars, middle_chars (null if plain), output."""
    return common.through_arrow(docs.select(F.col("doc_id").cast("long"), "text"), partial(_batches, seed), TRANSFORMED)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output of a form was made from; its markers stand in no part of such a text."""
    out = F.col(output)
    p, s, m = (mark.decode() for mark in (PREFIX, SUFFIX, MIDDLE))

    def between(left: str, right: str | None) -> Column:
        rest = F.substring_index(out, left, -1)
        return F.substring_index(rest, right, 1) if right else rest

    psm = F.concat(between(p, s), between(m, None), between(s, m))
    spm = F.concat(between(p, m), between(m, None), between(s, p))
    return F.when(F.col(form) == "plain", out).when(F.col(form) == "psm", psm).otherwise(spm)


def report(docs: DataFrame) -> DataFrame:
    """Digests instead of texts: output_sha256, restored_sha256."""
    rows = fill_in_middle(docs)
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored().cast("binary"), 256).alias("restored_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_settings(spark)
    return report(common.read(spark, sf_dir, "documents"))


SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), hashes AS (
  SELECT doc_id, text, u, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM units
), cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM hashes
), parts AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a+1:b], '') AS m, array_to_string(u[b+1:], '') AS s FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts
"""
