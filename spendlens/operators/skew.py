"""Exact ways around hot keys and groups of copies.

* ``collapse`` folds identical rows into one row with a count before a shuffle
  (partial aggregation does it on the map side), ``expand`` unfolds them.
* ``spread_join`` joins so that AQE can split the partition of a hot key.
* ``numbered`` gives consecutive numbers within groups of any size, without
  ever sorting a whole group in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import DataType, DoubleType, FloatType, NumericType

from spendlens.functions.columns import identity_text

COPIES = "copies"
CHUNK = 100_000  # copies unfolded from one row at a time
NUMBER_BUCKET_DIGITS = 4  # 16**4 buckets by md5 prefix


def collapse(df: DataFrame, columns: Sequence[str], copies: str = COPIES) -> DataFrame:
    """One row per distinct value of ``columns`` and how often it occurs."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(copies))


def expand(
    df: DataFrame,
    copies: str = COPIES,
    index: str | None = None,
    spread: bool = False,
    each: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``copies`` rows for each row, optionally with their number from 0.

    Works chunk by chunk so that no array grows with the number of copies. With
    ``spread`` one shuffle of the chunks deals those of a row to different tasks.
    ``each`` adds columns to the chunks after that shuffle, which need not carry them.
    """
    out = _chunks(df, copies)
    if spread:
        plain = [c for c, kind in df.dtypes if not kind.startswith(("array", "map", "struct"))]
        out = out.repartition(*plain, "_chunk")
    out = each(out) if each else out
    return _copies(out, copies, index)


def expand_stored(df: DataFrame, copies: str = COPIES, index: str | None = None) -> DataFrame:
    """``expand`` of a stored table: only rows of more than one chunk are shuffled.

    Reads the table twice; the statistics of its files tell where there are no such rows.
    """
    few, many = (df.where(kept) for kept in (F.col(copies) <= CHUNK, F.col(copies) > CHUNK))
    return expand(few, copies, index).unionByName(expand(many, copies, index, spread=True))


def _chunks(df: DataFrame, copies: str) -> DataFrame:
    """One row per chunk of copies."""
    last = F.floor((F.col(copies) - 1) / F.lit(CHUNK))
    return df.where(F.col(copies) > 0).withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))


def _copies(chunks: DataFrame, copies: str, index: str | None) -> DataFrame:
    first = F.col("_chunk") * F.lit(CHUNK)
    last = F.least(first + F.lit(CHUNK), F.col(copies)) - 1
    out = chunks.withColumn("_copy", F.explode(F.sequence(first, last))).drop("_chunk", copies)
    return out.withColumnRenamed("_copy", index) if index else out.drop("_copy")


def expand_sorted(df: DataFrame, order: Sequence[Column], copies: str = COPIES) -> DataFrame:
    """``expand`` in a global order. Chunks are sorted, not copies: their number is
    the last sort key, so the sort can cut a long run of copies into several
    partitions, and copies are unfolded where they then stand."""
    return _copies(_chunks(df, copies).orderBy(*order, "_chunk"), copies, None)


def spread_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    null_safe: Sequence[str] = (),
    keep_hash: str | None = None,
) -> DataFrame:
    """Equi-join of raw rows with a side that may already be arranged by the key.

    AQE turns a side it measured as small into a broadcast, and splits the
    skewed partitions of a larger join, but the latter only where both sides
    come straight from a shuffle made for this join. A side that was grouped or
    joined by the same key has no such shuffle, and a hot key of the other side
    would stay in one task. The key's hash as a further join key makes Spark
    shuffle both sides for this join. Columns of ``null_safe`` also match NULL
    with NULL. Number columns of different types are compared as Spark does.
    ``keep_hash`` keeps the hash under that name: a grouping by it and the keys
    needs no shuffle after that of the join.
    """
    keys = [*on, *null_safe]
    hashed = F.xxhash64(*[_hash_input(key, big, small) for key in keys])
    left = big.withColumn("_hash", hashed).alias("l")
    right = small.withColumn("_hash", hashed).alias("r")
    condition = F.col("l._hash") == F.col("r._hash")
    for key in on:
        condition = condition & (F.col(f"l.{key}") == F.col(f"r.{key}"))
    for key in null_safe:
        condition = condition & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    kept = [F.col(f"l.{c}") for c in big.columns]
    if how != "left_semi":
        kept += [F.col(f"r.{c}") for c in small.columns if c not in keys]
    if keep_hash:
        kept.append(F.col("l._hash").alias(keep_hash))
    return left.join(right, condition, how).select(*kept)


def _hash_input(key: str, left: DataFrame, right: DataFrame) -> Column:
    """The key in the type that Spark compares both sides in, with one zero."""
    kinds = [df.schema[key].dataType for df in (left, right)]
    column = F.col(key)
    if kinds[0] != kinds[1]:
        if not all(isinstance(kind, NumericType) for kind in kinds):
            raise TypeError(f"{key} has types that do not compare: {sorted(k.simpleString() for k in kinds)}")
        column = column.cast(_common_type(left.sparkSession, *kinds))
    if any(isinstance(kind, (DoubleType, FloatType)) for kind in kinds):
        column = column + F.lit(0).cast("byte")  # -0.0 equals 0.0 but has other bits
    return column


def _common_type(spark: SparkSession, a: DataType, b: DataType) -> DataType:
    """The type both sides are cast to by a comparison; only analysed, never run."""
    nulls = f"coalesce(CAST(NULL AS {a.simpleString()}), CAST(NULL AS {b.simpleString()}))"
    return spark.range(0).select(F.expr(nulls).alias("k")).schema["k"].dataType


def numbered(
    df: DataFrame,
    group: Sequence[str],
    identity: Sequence[str],
    name: str,
    weight: str | None = None,
    digits: int = NUMBER_BUCKET_DIGITS,
    written: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add ``name``: position from 0 within the group, in md5 order of ``identity``.

    ``identity`` must tell the rows of a group apart and the group columns must
    not be NULL. With ``weight`` a row takes that many positions and gets the
    first. A group is cut into buckets by md5 prefix; only bucket totals, at
    most 16**digits per group, are summed up in order. ``written`` gives columns
    that others determine; with it they and the md5 are not shuffled, but written
    out again after the shuffle.
    """
    size = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    md5 = F.md5(identity_text(df, identity))
    keyed = df.withColumn("_md5", md5).withColumn("_size", size).withColumn("_bucket", F.substring("_md5", 1, digits))
    cell = [*group, "_bucket"]
    totals = keyed.groupBy(*cell).agg(F.sum("_size").alias("_total"))
    before = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    before = before.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(*cell, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    inside = W.partitionBy(*cell).orderBy("_md5", *identity).rowsBetween(W.unboundedPreceding, -1)
    dealt = keyed
    if written:
        dealt = keyed.drop("_md5", *written).repartition(*cell).withColumns(dict(written)).withColumn("_md5", md5)
    placed = dealt.withColumn("_in", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    out = placed.join(starts, cell).withColumn(name, (F.col("_start") + F.col("_in")).cast("long"))
    return out.drop("_md5", "_size", "_bucket", "_in", "_start")
