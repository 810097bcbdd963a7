"""MinHash near-duplicates through an LSH forest.

Every text is a set of shingles of five words. A document's signature has TREES * LEVELS minima; a tree of the
forest sorts all documents by its own LEVELS minima in order, so that documents with a long common prefix are
neighbours. A region of a tree is a run of documents with a common prefix: it starts at MIN_DEPTH and goes deeper
where more than REGION documents share that prefix (adaptive depth). Within a region all pairs whose signatures
agree well enough are candidates. A region that is too large is also cut into parts of its order, each beside the
region's hubs: the documents nearest to the most frequent values, as the text is that all others are copies of. Two documents at the threshold of 0.75 share a prefix of two in some tree with probability 1 - (1 - 0.75^2)^16
= 0.999998. A run of up to REGION documents is never cut between tasks. Parts and hubs only link the greater part of a larger
run early: afterwards the documents of all larger runs are joined on the prefixes of their sets. In one order of all
shingles, two sets at the threshold share one of their first n - ceil(0.75 n) + 1, so a pair of different components is
either excluded by that bound or becomes a candidate; shingles that a sample finds common come last in the order, which
keeps shared templates out of the prefixes. Documents of one shingle are set side by side in pairs of blocks, but for
blocks of one component.

Equal word sequences are folded before the forest. Candidates that a region's own spanning forest needs are
confirmed on the full sets. Afterwards all remaining candidates between different components are confirmed as well: the
sets of their documents, not their pairs, are brought together by region, and a region compares its own.

Cases: a null or empty text has no shingles and is linked with nothing, itself its component. Rows without doc_id
come back with a null component and are kept. Repeated rows are one document and come back as often. Extra columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm import common
from spendlens.llm.components import components
from spendlens.session import apply_settings

WORDS = 5
NUMERATOR, DENOMINATOR = 75, 100  # similarity of at least 75 / 100
TREES, LEVELS = 16, 8
MIN_DEPTH = 2
REGION = 2048
RANGE_ROWS = 50_000  # of an order in one task
HUBS = 32  # most central documents of a larger region, set beside every part of it
BLOCK = 1024  # documents of one shingle side by side in one task, twice
SAMPLED, COMMON = 20_000, 200_000  # documents to find common shingles in; the most common ones
BITMAP_WORDS = 1 << 17  # of 64 bits
CLOSE = 0.6  # share of equal minima from which a pair is a candidate: four standard errors below 0.75

_rng = np.random.default_rng(75)
_FACTORS = _rng.integers(1, 2**63, TREES * LEVELS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _rng.integers(0, 2**63, TREES * LEVELS, dtype=np.uint64)


def _sets(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct sorted shingles of all texts, where each starts, and two hashes of the word sequence."""
    words, starts = common.word_hashes(values, common.SPACED)
    runs, at = common.shingles(words, starts, WORDS)
    order = np.lexsort((runs, np.repeat(np.arange(len(values)), np.diff(at))))
    runs, owner = runs[order], np.repeat(np.arange(len(values)), np.diff(at))
    first = np.ones(len(runs), dtype=bool)
    first[1:] = (runs[1:] != runs[:-1]) | (owner[1:] != owner[:-1])
    runs, owner = runs[first], owner[first]
    at = np.searchsorted(owner, np.arange(len(values) + 1))
    place = np.arange(len(words), dtype=np.uint64) - np.repeat(starts[:-1], np.diff(starts)).astype(np.uint64)
    spread = [common.mix(words + common.mix(place + np.uint64(k))) for k in (1, 2**40)]
    sequence = np.zeros((len(values), 2), dtype=np.uint64)
    some = np.flatnonzero(np.diff(starts) > 0)
    if len(some):
        for k in (0, 1):
            sequence[some, k] = np.add.reduceat(spread[k], starts[some])
    return runs, at, sequence


def _signatures(runs: np.ndarray, at: np.ndarray) -> np.ndarray:
    """TREES * LEVELS scrambled minima for each text that has shingles."""
    out = np.empty((len(at) - 1, TREES * LEVELS), dtype=np.uint64)
    for k in range(TREES * LEVELS):
        out[:, k] = np.minimum.reduceat(runs * _FACTORS[k] + _TERMS[k], at[:-1])
    return common.mix(out)


SKETCH = "doc_id long, n_shingles long, seq_a long, seq_b long, keys binary, signature binary"


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, values = batch.column(0), common.texts(batch.column(1))
        for a, b in common.slices(values):
            runs, at, sequence = _sets(values[a:b])
            sizes = np.diff(at)
            some = sizes > 0
            keys, bits = [None] * (b - a), [None] * (b - a)
            if some.any():
                minima = _signatures(runs, np.concatenate([at[:-1][some], at[-1:]]))
                key_rows = (minima >> np.uint64(48)).astype(">u2")
                bit_rows = (minima & np.uint64(0xFF)).astype(np.uint8)
                for row, i in enumerate(np.flatnonzero(some)):
                    keys[i], bits[i] = key_rows[row].tobytes(), bit_rows[row].tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(a, b - a).cast(pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array(sequence[:, 0].view(np.int64)), pa.array(sequence[:, 1].view(np.int64)),
                    pa.array(keys, pa.binary()), pa.array(bits, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "seq_a", "seq_b", "keys", "signature"],
            )


def sketches(docs: DataFrame) -> DataFrame:
    """One row per row: size of the set, hash of the word sequence, tree keys and signature (null for empty sets)."""
    return common.through_arrow(docs.select(F.col("doc_id").cast("long"), "text"), _sketch_batches, SKETCH)


ACTIVE = "region long, doc long, signature binary"


def _close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of two signature tables agree in at least CLOSE of their places."""
    least = int(np.ceil(CLOSE * a.shape[1]))
    out = np.empty((len(a), len(b)), dtype=bool)
    for i in range(len(a)):
        out[i] = (b == a[i]).sum(axis=1, dtype=np.uint16) >= least
    return out


def _hubs(signature: np.ndarray) -> np.ndarray:
    """The rows that agree best with the most frequent value of each place: what the others are copies of."""
    usual = np.asarray([np.bincount(signature[:, k], minlength=256).argmax() for k in range(signature.shape[1])], dtype=np.uint8)
    return np.argsort(-(signature == usual).sum(axis=1), kind="stable")[:HUBS]


def _regions(tree: np.ndarray, keys: np.ndarray, signature: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of runs with a common prefix, deeper where more than REGION rows share one.

    ``keys`` has one column per level. A run that is too large is looked at in parts, each beside the run's hubs, and
    at the next level; at full depth the parts overlap by half.
    """
    ends = np.flatnonzero(np.concatenate([[True], tree[1:] != tree[:-1], [True]])) if len(tree) else np.empty(0, int)
    todo = [(int(a), int(b), 0) for a, b in zip(ends[:-1], ends[1:])]
    while todo:
        a, b, depth = todo.pop()
        if b - a < 2:
            continue
        if depth >= MIN_DEPTH and b - a <= REGION:
            yield np.arange(a, b)
            continue
        if depth >= MIN_DEPTH:
            hubs = a + _hubs(signature[a:b])
            step = REGION if depth < LEVELS else REGION // 2
            for start in range(a, b, step):
                yield np.union1d(hubs, np.arange(start, min(start + REGION, b)))
        if depth < LEVELS:
            level = keys[a:b, depth]
            cut = a + np.flatnonzero(np.concatenate([[True], level[1:] != level[:-1], [True]]))
            many = np.flatnonzero(np.diff(cut) > 1)
            todo.extend((int(cut[i]), int(cut[i + 1]), depth + 1) for i in many)


def _active_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the forest's rows in order, those with a candidate in their region."""
    table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if table is None or not table.num_rows:
        return
    docs = table.column("doc").to_numpy()
    tree = table.column("tree").to_numpy()
    levels = np.frombuffer(b"".join(table.column("path").to_pylist()), dtype=">u2").reshape(-1, LEVELS)
    signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(-1, TREES * LEVELS)
    del table
    order = np.lexsort((docs, *(levels[:, k] for k in reversed(range(LEVELS))), tree))
    docs, tree, levels, signature = docs[order], tree[order], levels[order], signature[order]
    out: list[tuple[int, int, bytes]] = []
    for rows in _regions(tree, levels, signature):
        near = _close(signature[rows], signature[rows])
        np.fill_diagonal(near, False)
        some = rows[near.any(axis=1)]
        if len(some):
            ends = np.asarray([tree[rows[0]], docs[rows[0]] + 2**40 * len(rows), docs[rows[-1]]], dtype=np.int64).view(np.uint64)
            name = int(common.mix(ends + np.arange(1, 4, dtype=np.uint64) * np.uint64(2**61 - 1)).sum().view(np.int64))
            out.extend((name, int(docs[i]), signature[i].tobytes()) for i in some)
        if len(out) > 20_000:
            yield _active_batch(out)
            out = []
    if out:
        yield _active_batch(out)


def _active_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    region, doc, signature = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(region, pa.int64()), pa.array(doc, pa.int64()), pa.array(signature, pa.binary())], names=["region", "doc", "signature"]
    )


def _in_trees(reps: DataFrame, *columns: str) -> DataFrame:
    """Each document in each tree with its path there and the prefix that all of a run have in common."""
    trees = reps.select("doc", "keys", *columns, F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    path = F.expr(f"substring(keys, tree * {2 * LEVELS} + 1, {2 * LEVELS})")
    return trees.select(F.col("tree").cast("byte").alias("tree"), path.alias("path"), F.substring(path, 1, 2 * MIN_DEPTH).alias("prefix"), "doc", *columns)


def large_runs(reps: DataFrame) -> DataFrame:
    """tree and prefix of the runs of more than REGION documents."""
    return _in_trees(reps).groupBy("tree", "prefix").count().where(F.col("count") > REGION).select("tree", "prefix")


def forest(reps: DataFrame, partitions: int, large: DataFrame) -> DataFrame:
    """Documents that have a candidate in some region: region, place in its order, doc, signature.

    Each tree's order is cut into ranges of equal size, by the minima and in large runs also by document, so no prefix
    is too common for a task and other runs stay whole. Large runs are looked at again by their prefixes.
    """
    marked = _in_trees(reps, "signature").join(F.broadcast(large.withColumn("large", F.lit(True))), ["tree", "prefix"], "left")
    rows = marked.select("tree", "prefix", "path", "doc", "signature", F.when(F.col("large"), F.struct("path", "doc")).alias("within"))
    rows = rows.repartitionByRange(partitions, "tree", "prefix", "within").select("tree", "path", "doc", "signature")
    return rows.mapInArrow(_active_batches, ACTIVE)


def _prefixes(common_shingles: np.ndarray | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of each document (all of them without ``common_shingles``, or those of its prefix).

    ``common_shingles`` is sorted by value with the rank of each; uncommon ones come first, by value.
    """
    for batch in batches:
        ids, values = batch.column(0).to_numpy(), common.texts(batch.column(1))
        for a, b in common.slices(values):
            runs, at, _ = _sets(values[a:b])
            doc, out = [], []
            for i in range(b - a):
                own = runs[at[i] : at[i + 1]]
                if common_shingles is not None:
                    rank = np.zeros(len(own), dtype=np.int64)
                    if len(common_shingles):
                        place = np.minimum(np.searchsorted(common_shingles["shingle"], own), len(common_shingles) - 1)
                        rank = np.where(common_shingles["shingle"][place] == own, common_shingles["rank"][place], 0)
                    least = -(-NUMERATOR * len(own) // DENOMINATOR)
                    own = own[np.lexsort((own, rank))][: len(own) - least + 1]
                doc.append(np.full(len(own), ids[a + i]))
                out.append(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(doc), pa.int64()), pa.array(np.concatenate(out).view(np.int64))], names=["doc", "shingle"]
            )


def _common_shingles(texts: DataFrame, n: int) -> np.ndarray:
    """The most common shingles of a sample, with their counts as ranks. Which they are decides the work, not the result."""
    some = texts.where(F.pmod(F.xxhash64("doc", F.lit(7)), F.lit(-(-n // SAMPLED))) == 0)
    counts = common.through_arrow(some, partial(_prefixes, None), "doc long, shingle long").groupBy("shingle").count().where("count > 2")
    rows = counts.orderBy(F.desc("count"), "shingle").limit(COMMON).collect()
    out = np.array([(r[0] % 2**64, r[1]) for r in rows], dtype=[("shingle", np.uint64), ("rank", np.int64)])
    return np.sort(out, order="shingle")


def side_by_side(members: DataFrame, docs: DataFrame) -> DataFrame:
    """Regions (region, doc, signature, component) in which any two similar ``members`` of different components meet."""
    members = common.kept(members)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text").join(members.select("doc"), "doc", "left_semi")
    texts = common.kept(texts)
    found = partial(_prefixes, _common_shingles(texts, members.count()))
    postings = common.kept(common.through_arrow(texts, found, "doc long, shingle long").distinct())
    postings = postings.join(members.select("doc", "component"), "doc")
    mixed = postings.groupBy("shingle").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    postings = common.kept(postings.join(mixed.where("least < most").select("shingle"), "shingle", "left_semi"))
    sizes = postings.groupBy("shingle", "component").agg(F.count("*").alias("n"))
    heavy = F.col("n") > BLOCK
    light = sizes.where(~heavy).groupBy("shingle").agg(F.sum("n").alias("total"))
    of = sizes.join(light, "shingle", "left")
    # a large component has blocks of its own, the others share some
    part = F.when(heavy, F.struct(F.col("component").alias("own"), F.ceil(F.col("n") / BLOCK).alias("blocks"))).otherwise(
        F.struct(F.lit(None).cast("long").alias("own"), F.ceil(F.col("total") / BLOCK).alias("blocks"))
    )
    of = common.kept(of.select("shingle", "component", part.alias("part")))
    parts = of.groupBy("shingle").agg(F.collect_set("part").alias("parts"))
    every = F.flatten(F.transform("parts", lambda p: F.transform(F.sequence(F.lit(1).cast("long"), p["blocks"]), lambda k: F.struct(p["own"].alias("own"), k.alias("k")))))
    here = F.struct(F.col("part.own").alias("own"), (F.pmod(F.xxhash64("doc"), F.col("part.blocks")) + 1).alias("k"))
    rows = postings.join(of, ["shingle", "component"]).join(parts.select("shingle", every.alias("blocks")), "shingle")
    rows = rows.select("shingle", "doc", "component", here.alias("here"), "blocks")
    rows = rows.select("*", F.explode("blocks").alias("other")).where("here.own IS NULL OR other.own IS NULL OR here.own <> other.own")
    region = F.xxhash64("shingle", F.least("here", "other"), F.greatest("here", "other"))
    return rows.select(region.alias("region"), "doc").distinct().join(members, "doc").select("region", "doc", "signature", "component")


PAIRS = "a long, b long"


def _by_region(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one region after the other, from rows sorted by region."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        region = batch.column("region").to_numpy()
        cuts = [0, *(np.flatnonzero(region[1:] != region[:-1]) + 1).tolist(), len(region)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            if held and held[0].column("region")[0].as_py() != int(region[a]):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _bits(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(-1, TREES * LEVELS)


def _spanning_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The candidates that hold each region's documents together."""
    found: set[tuple[int, int]] = set()
    for table in _by_region(batches):
        doc = table.column("doc").to_pylist()
        found.update((doc[i], doc[j]) for i, j in _spanning(_bits(table)))
        if len(found) > 100_000:
            yield _pair_batch(found)
            found = set()
    if found:
        yield _pair_batch(found)


def _open_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that have a candidate in another component."""
    for table in _by_region(batches):
        part, bits = table.column("component").to_numpy(), _bits(table)
        if (part != part[0]).any():
            near = _close(bits, bits) & (part[:, None] != part[None, :])
            yield from table.filter(pa.array(near.any(axis=1))).to_batches()


def _settled_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between components, from all candidates of a region. A pair is looked at in one region only."""
    for table in _by_region(batches):
        doc, part, bits = table.column("doc").to_pylist(), table.column("component").to_numpy(), _bits(table)
        sets = [np.frombuffer(v, np.uint64) for v in table.column("set").to_pylist()]
        regions = [set(v) for v in table.column("regions").to_pylist()]
        here = table.column("region")[0].as_py()
        group = {int(c): int(c) for c in part}

        def root(c: int) -> int:
            while group[c] != c:
                c = group[c]
            return c

        found: set[tuple[int, int]] = set()
        near = np.triu(_close(bits, bits) & (part[:, None] != part[None, :]), 1)
        for i, j in zip(*np.nonzero(near)):
            x, y = root(int(part[i])), root(int(part[j]))
            if x != y and min(regions[i] & regions[j]) == here and _linked(sets[i], sets[j]):
                found.add((doc[i], doc[j]))
                group[max(x, y)] = min(x, y)
        if found:
            yield _pair_batch(found)


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = np.sort(np.concatenate([x, y]), kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return DENOMINATOR * shared >= NUMERATOR * (len(both) - shared)


def _pair_batch(pairs: set[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*((min(p), max(p)) for p in pairs))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _spanning(signature: np.ndarray) -> list[tuple[int, int]]:
    """The links of a maximum spanning forest over candidates, by agreement of signatures."""
    n, least = len(signature), int(np.ceil(CLOSE * signature.shape[1]))
    best = np.zeros(n, dtype=np.int32)
    parent = np.full(n, -1)
    out, left = [], np.ones(n, dtype=bool)
    for _ in range(n):
        i = int(np.argmax(np.where(left, best, -1)))
        left[i] = False
        if best[i] >= least:
            out.append((int(parent[i]), i))
        same = (signature == signature[i]).sum(axis=1)
        better = left & (same > best)
        best[better], parent[better] = same[better], i
    return out


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, values = batch.column(0), common.texts(batch.column(1))
        for a, b in common.slices(values):
            runs, at, _ = _sets(values[a:b])
            rows = [runs[at[i] : at[i + 1]].tobytes() for i in range(b - a)]
            yield pa.RecordBatch.from_arrays([ids.slice(a, b - a).cast(pa.int64()), pa.array(rows, pa.binary())], names=["doc", "set"])


def _confirm_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yes = [
            _linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64))
            for x, y in zip(batch.column("set_a"), batch.column("set_b"))
        ]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(yes, pa.bool_()))


def likely(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose doc may be among ``wanted``: a bitmap of fixed size, so that few others reach a shuffle."""
    place = F.pmod(F.xxhash64("doc"), F.lit(BITMAP_WORDS))
    bit = F.pmod(F.shiftright(F.xxhash64("doc"), 40), F.lit(64)).cast("int")
    words = wanted.groupBy(place.alias("id")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"))
    every = rows.sparkSession.range(BITMAP_WORDS).join(words, "id", "left").select("id", F.coalesce("bits", F.lit(0)).alias("bits"))
    bitmap = every.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "bits"))), lambda w: w["bits"]).alias("bitmap"))
    return rows.where(F.getbit(F.get(bitmap.scalar(), place.cast("int")), bit) == 1)


def sets_of(needed: DataFrame, docs: DataFrame) -> DataFrame:
    """The full sets of the documents in ``needed`` (column doc), made again from their texts."""
    needed = common.kept(needed)
    texts = likely(docs.select(F.col("doc_id").cast("long").alias("doc"), "text"), needed).join(needed, "doc", "left_semi")
    return common.kept(common.through_arrow(texts, _set_batches, "doc long, set binary").dropDuplicates(["doc"]))


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    sets = sets_of(pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct(), docs)
    left = pairs.join(sets.select(F.col("doc").alias("a"), F.col("set").alias("set_a")), "a")
    both = left.join(sets.select(F.col("doc").alias("b"), F.col("set").alias("set_b")), "b")
    return common.through_arrow(both.select("a", "b", "set_a", "set_b"), _confirm_batches, PAIRS)


def _regionwise(rows: DataFrame, partitions: int) -> DataFrame:
    return rows.repartition(partitions, "region").sortWithinPartitions("region", "doc")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept (see the module for all cases)."""
    spark = docs.sparkSession
    sketch = common.kept(sketches(docs))
    # a task holds one range of one order at a time
    ranges = -(-sketch.count() * TREES // RANGE_ROWS)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), TREES, ranges)
    some = sketch.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = some.groupBy("seq_a", "seq_b").agg(
        F.min("doc_id").alias("doc"), F.any_value("keys").alias("keys"), F.any_value("signature").alias("signature")
    )
    classes = common.kept(classes)
    large = common.kept(large_runs(classes))
    active = common.kept(forest(classes, partitions, large))
    pairs = common.kept(_regionwise(active, partitions).mapInArrow(_spanning_batches, PAIRS).distinct())
    links = common.kept(confirmed(pairs, docs))
    parts = components(links)
    named = active.join(parts.select(F.col("node").alias("doc"), "component"), "doc", "left")
    named = named.select("region", "doc", "signature", F.coalesce("component", "doc").alias("component"))
    if not large.isEmpty():
        crowd = _in_trees(classes).join(F.broadcast(large), ["tree", "prefix"], "left_semi").select("doc").distinct()
        crowd = classes.join(crowd, "doc", "left_semi").join(parts.withColumnRenamed("node", "doc"), "doc", "left")
        crowd = crowd.select("doc", "signature", F.coalesce("component", "doc").alias("component"))
        named = named.union(side_by_side(crowd, docs))
    named = _regionwise(named, partitions)
    opened = common.kept(named.mapInArrow(_open_batches, f"{ACTIVE}, component long"))
    if not opened.isEmpty():
        sets = sets_of(opened.select("doc").distinct(), docs)
        regions = opened.groupBy("doc").agg(F.collect_set("region").alias("regions"))  # a few for each tree and level
        rows = _regionwise(opened.join(regions, "doc").join(sets, "doc"), partitions)
        parts = components(links.union(rows.mapInArrow(_settled_batches, PAIRS)))
    ids = classes.select("seq_a", "seq_b", "doc").join(parts.withColumnRenamed("node", "doc"), "doc", "left")
    found = ids.select("seq_a", "seq_b", F.coalesce("component", "doc").alias("component"))
    empty = F.col("n_shingles") == 0
    joined = sketch.select("doc_id", "n_shingles", "seq_a", "seq_b").join(found, ["seq_a", "seq_b"], "left")
    component = F.when(F.col("doc_id").isNull() | empty, F.col("doc_id")).otherwise(F.col("component"))
    out = joined.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that stay: one row of each group of near-duplicates, and rows without doc_id."""
    rows, given = common.set_apart(docs, ["doc_id", "text"])
    stay = near_duplicates(rows).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    one = rows.where("doc_id IS NOT NULL").join(stay, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return one.unionByName(rows.where("doc_id IS NULL")).select(*given)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_settings(spark)
    return near_duplicates(common.read(spark, sf_dir, "documents"))


SQL = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS r,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, r, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s
  FROM words
), one AS (SELECT doc_id, s FROM sets WHERE len(s) > 0),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM one),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k, any_value(a.n) AS n, any_value(b.n) AS m
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (SELECT u, v FROM shared WHERE 100 * k >= 75 * (n + m - k)),
twoway AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (
  WITH RECURSIVE walk(u, v) AS (
    SELECT u, v FROM twoway UNION SELECT walk.u, twoway.v FROM walk JOIN twoway ON walk.v = twoway.u
  ) SELECT u, min(v) AS v FROM walk GROUP BY u
)
SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce(v, doc_id)) AS component_id,
  doc_id = least(doc_id, coalesce(v, doc_id)) AS kept
FROM sets LEFT JOIN reach ON doc_id = u
"""
