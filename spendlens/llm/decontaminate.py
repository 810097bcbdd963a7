"""Benchmark decontamination with an Aho-Corasick automaton over normalised test items.

A text's words are runs of ASCII digits, letters and characters from U+0080 on, with A-Z in lower case. The windows of
an item are its runs of ten words; a shorter item is one window. All windows make one automaton, which reads each
text once; offsets of what it finds are mapped back to words and characters of the original.

The windows of up to SHARD_BYTES go to the tasks at once. Larger benchmarks are cut into shards of that size by
item, found by counting first; the automata of all shards then read each text one after the other, in a job of its
own each, and the findings of a document are joined. Results do not depend on the number of shards.

Cases: null texts and texts without words have no windows and no hits; so have items. Rows without doc_id and
repeated rows come back each on its own. Items without item_id never count. Extra columns are ignored. Empty tables:
no documents give no rows, no items give documents without hits.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm import common
from spendlens.session import apply_settings

WINDOW = 10
SHARD_BYTES = 16 << 20


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """The windows of an item, each as its words between single spaces."""
    words = text.translate(common.ALNUM_OR_SPACE).split()
    if not words:
        return []
    return [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


def automaton(items: list[tuple[int, bytes]], size: int = WINDOW) -> ahocorasick.Automaton | None:
    """The automaton of all windows; a window's value is its number of words and the items that have it."""
    owners: dict[bytes, set[int]] = defaultdict(set)
    for item_id, text in items:
        for window in windows(text, size):
            owners[window].add(item_id)
    if not owners:
        return None
    found = ahocorasick.Automaton()
    for window, ids in owners.items():
        found.add_word(f" {window.decode()} ", (window.count(b" ") + 1, sorted(ids)))
    found.make_automaton()
    return found


def scan(text: bytes, found: ahocorasick.Automaton | None) -> tuple[int, list[tuple[int, int]], set[int]]:
    """Number of words, hit runs of words as (first, last), and the items found."""
    words = text.translate(common.ALNUM_OR_SPACE).split()
    if not words or found is None:
        return len(words), [], set()
    line = f" {b' '.join(words).decode()} "
    hits, items, gaps = [], set(), None
    for end, (size, ids) in found.iter(line):
        if gaps is None:  # where each word ends: at the next space
            gaps = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), np.uint32) == 32)
        last = int(np.searchsorted(gaps, end)) - 1
        hits.append((last - size + 1, last))
        items.update(ids)
    return len(words), _joined(hits), items


def _joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def _spans(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as ranges of characters of the original text."""
    inside = common.ALNUM[np.frombuffer(text.translate(common.FOLD), np.uint8)]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return [(len(text[: first[a]].decode()), len(text[: last[b]].decode())) for a, b in runs]


FINDINGS = (
    "row long, doc_id long, n_words long, words array<struct<first:long,last:long>>, "
    "spans array<struct<start:long,end:long>>, items array<long>"
)


def _items(benchmark: DataFrame) -> tuple[DataFrame, int]:
    """The distinct items and the number of shards they make."""
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long"), "text").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return items, max(1, -(-total // SHARD_BYTES))


def _shards(items: DataFrame, n: int) -> Iterator[list[tuple[int, bytes]]]:
    """The items in shards of bounded size; one at a time reaches the driver."""
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r[0], r[1].encode()) for r in part.toLocalIterator()]


def find(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per row: doc_id, n_words, hit runs of words, their spans of characters, and the items found."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    items, n = _items(benchmark)
    if n > 1:
        rows = common.kept(rows)  # so that all jobs see the same numbers
    results = [_scanned(rows, shard, size) for shard in _shards(items, n)]
    if n == 1:
        return results[0].drop("row")
    both = results[0]
    for other in results[1:]:  # more than one automaton: their findings of a row are put together
        both = both.union(other)
    joined = both.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("words")).alias("words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return joined.select("doc_id", "n_words", _merge("words", "first", "last", 1), _merge("spans", "start", "end", 0), "items")


def _merge(name: str, low: str, high: str, gap: int) -> F.Column:
    """Sorted ranges of an array joined where they touch."""
    step = f"""aggregate(array_sort({name}), cast(array() AS array<struct<{low}:long,{high}:long>>), (all, x) ->
      CASE WHEN size(all) > 0 AND x.{low} <= element_at(all, -1).{high} + {gap}
      THEN concat(slice(all, 1, size(all) - 1), array(named_struct('{low}', element_at(all, -1).{low},
        '{high}', greatest(element_at(all, -1).{high}, x.{high}))))
      ELSE concat(all, array(x)) END)"""
    return F.expr(step).alias(name)


def _scanned(rows: DataFrame, items: list[tuple[int, bytes]], size: int) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast(items)

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(held.value, size)
        for batch in batches:
            out = []
            for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), common.texts(batch.column(2))):
                n, runs, ids = scan(text, found)
                spans = _spans(text, runs) if runs else []
                out.append({
                    "row": row, "doc_id": doc_id, "n_words": n, "words": [{"first": a, "last": b} for a, b in runs],
                    "spans": [{"start": a, "end": b} for a, b in spans], "items": sorted(ids),
                })
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW)

    return common.through_arrow(rows, batches_of, FINDINGS)


_ARROW = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("words", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.int64())),
])


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Digest per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find(docs, benchmark)
    hit = F.aggregate("words", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), (F.size("words") > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows without a hit, with their own columns."""
    clean = docs
    for shard in _shards(*_items(benchmark)):
        clean = clean.where(~_hit_by(docs.sparkSession, shard, size)("text"))
    return clean


def _hit_by(spark: SparkSession, items: list[tuple[int, bytes]], size: int):
    """A test of texts for any window of the items."""
    held = spark.sparkContext.broadcast(items)

    @F.arrow_udf("boolean")
    def hit(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        found = automaton(held.value, size)
        for batch in batches:
            yield pa.array([bool(scan(t, found)[1]) for t in common.texts(batch)], pa.bool_())

    return hit


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_settings(spark)
    return report(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark"))


SQL = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), items AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE item_id IS NOT NULL
), item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k,
    unnest(list_transform(range(1, greatest(len(w) - 10, 0) + 2), lambda i: array_to_string(w[i:i+9], ' '))) AS g
  FROM items WHERE len(w) > 0
), sizes AS (SELECT DISTINCT k FROM item_windows),
places AS (
  SELECT r, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM words, sizes WHERE len(w) >= k
), found AS (
  SELECT r, i, p.k, item_id FROM places p JOIN item_windows x ON p.k = x.k AND array_to_string(p.w[p.i:p.i+p.k-1], ' ') = x.g
), hits AS (
  SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS j FROM found) GROUP BY r
), ids AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS all_ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(all_ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hits USING (r) LEFT JOIN ids USING (r)
"""
