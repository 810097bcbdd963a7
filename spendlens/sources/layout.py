"""How tables lie in their files: bucketed by project, or clustered by it where one project is too large.

Tables of one build that are bucketed alike are grouped and joined by project without a shuffle, and a lookup of one
project reads one bucket. Within a file rows are sorted by project, and a Bloom filter of each row group tells lookups
in sheets that are clustered, and by other ids, to pass it over. A project that holds more than LARGEST of a table would
make one bucket, and so one task of every join, too long; such a table is cut by ranges of project and row instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET_BYTES = 128 << 20
LEAST_BUCKETS, MOST_BUCKETS = 8, 65_536
LARGEST = 4.0  # times the mean bucket


@dataclass(frozen=True)
class Layout:
    """``column`` is None for a table that has no such column; ``bucketed`` is False for one that is only clustered."""

    column: str | None
    buckets: int
    bucketed: bool

    def facts(self) -> dict[str, Any]:
        return asdict(self)


def buckets_for(total_bytes: int) -> int:
    """A power of two, the same for all tables of a build, so that they fit together."""
    wanted = max(LEAST_BUCKETS, min(MOST_BUCKETS, -(-total_bytes // BUCKET_BYTES)))
    return 1 << (wanted - 1).bit_length()


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def layout_of(table: DataFrame, column: str, buckets: int) -> Layout:
    """Bucketed, unless one value is too frequent, the column is missing, or there are no rows (buckets would have no file)."""
    if column not in table.columns:
        return Layout(None, buckets, False)
    counts = table.groupBy(F.col(quoted(column)).alias("k")).count()
    most, rows = counts.agg(F.max("count"), F.sum("count")).first()
    return Layout(column, buckets, bool(rows) and most <= max(1, LARGEST * rows / buckets))


def write(
    table: DataFrame, path: str, layout: Layout, observed: Callable[[DataFrame], DataFrame] = lambda df: df, lookups: bool = True
) -> None:
    """Write a table; ``observed`` may add measures to the rows as they are written, behind all shuffles.

    Without ``lookups`` row groups carry no Bloom filters, which are larger than small buckets.
    """
    if layout.column is None:
        observed(table).write.parquet(path)
        return
    key = F.col(quoted(layout.column))
    bloom = {f"parquet.bloom.filter.enabled#{layout.column}": "true"} if lookups else {}
    if not layout.bucketed:
        # rows of one project may fill many files: the row's hash is the second key of the ranges
        mixed = F.xxhash64(*[F.col(quoted(c)) for c in table.columns])
        rows = table.repartitionByRange(layout.buckets, key, mixed).sortWithinPartitions(key)
        observed(rows).write.options(**bloom).parquet(path)
        return
    name = f"layout_{uuid.uuid4().hex}"
    rows = table.repartition(layout.buckets, key)  # dealt as buckets are, so every task writes one file
    writer = observed(rows).write.format("parquet").options(**bloom).bucketBy(layout.buckets, layout.column).sortBy(layout.column)
    writer.option("path", path).saveAsTable(name)
    table.sparkSession.sql(f"DROP TABLE {name}")  # the files stay; readers declare them again


def stored_by(rows: DataFrame, column: str, buckets: int, place: str) -> DataFrame:
    """Stored rows once more, in buckets of the column; left as they are where one value is too frequent for that."""
    placed = layout_of(rows, column, buckets)
    if not placed.bucketed:
        return rows
    write(rows, place, placed, lookups=False)
    return read(rows.sparkSession, place, placed.facts())


def read(spark: SparkSession, path: str, facts: dict[str, Any] | None) -> DataFrame:
    """The table, known to be bucketed where it is; one declaration in the session's catalog for each path."""
    table = spark.read.parquet(path)
    if not facts or not facts["bucketed"]:
        return table
    name = "stored_" + uuid.uuid5(uuid.NAMESPACE_URL, path).hex
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in table.schema.fields)
        key = quoted(facts["column"])
        place = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {facts['buckets']} BUCKETS LOCATION '{place}'"
        )
    return spark.table(name)
