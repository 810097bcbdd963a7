"""ZIP archives of CSV sheets to Parquet tables.

Each archive is unzipped by one task, in a stream, into blocks; the blocks of
all archives are parsed in parallel (see ``blocks``). The parsed rows are
written once as text cells; types are inferred and tables are written from
there. A file that cannot be read becomes an error row. All tables of a run are
one build, which readers see when it is complete (see ``published``).
"""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from spendlens.functions import fixed_values as fv
from spendlens.functions.columns import to_number
from spendlens.sources import blocks, layout, published
from spendlens.sources.catalog import table_catalog
from spendlens.sources.inference import typed_columns

ROWS_PER_FILE = 250_000
TABLES_AT_ONCE = 8
# blocks are written one by one, not gathered by the hundred before Parquet looks at their size
BLOCK_FILES = {"parquet.block.size": 32 << 20, "parquet.page.size.row.check.min": 1, "parquet.block.size.row.check.min": 1}


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, file_name) of every ZIP file in the folder; contents are not read."""
    files = spark.read.format("binaryFile").load(folder.rstrip("/") + "/*.zip").select("path", "length")
    return files.withColumn("file_name", F.element_at(F.split("path", "/"), -1))


def read_archives(archives: DataFrame, scratch: str | None = None) -> DataFrame:
    """Header and cells of every CSV row of every archive, as text.

    One row per CSV row; an archive without rows gives one row without cells,
    a broken one a row with an error. With a folder ``scratch`` the unzipped
    blocks are written there and read back, else archives are unzipped twice.
    """
    unzipped = blocks.unzipped(archives, _open)
    if scratch:
        unzipped.write.mode("overwrite").options(**BLOCK_FILES).parquet(scratch)
        unzipped = archives.sparkSession.read.schema(blocks.BLOCKS).parquet(scratch)
    return blocks.parsed(unzipped)


def ingest(spark: SparkSession, folder: str, target: str, split_archive: str = fv.SPLIT_ARCHIVE) -> DataFrame:
    """Rebuild all tables from the archives in ``folder`` and publish them below ``target``.

    A build holds one Parquet table per archive, the summary and detail tables
    of the payment sheet, the catalog ``table_index`` and the list
    ``ingest_errors`` of archives left out. Rows and missing values are counted
    while the tables are written and stand in the manifest. Returns the catalog.
    """
    target = target.rstrip("/")
    build = published.new_build(target)
    archives = list_archives(spark, folder)
    staged = _staged_cells(archives, f"{build}/_cells", f"{build}/_blocks")
    # one row per archive: header, first error
    outcome = staged.groupBy("path").agg(
        F.first("header", ignorenulls=True).alias("header"), F.max("error").alias("error")
    )
    readable = archives.join(outcome.where(F.col("error").isNull()).select("path", "header"), "path")
    named = table_catalog(readable.select("path", "file_name"), split_archive)
    # of archives that claim the same table the first by name is taken
    owners = named.groupBy("table_name").agg(F.min("file_name").alias("file_name"))
    catalog = named.join(owners, ["table_name", "file_name"], "left_semi")
    catalog.write.parquet(f"{build}/table_index")
    stored = spark.read.parquet(f"{build}/table_index")

    failed = outcome.where(F.col("error").isNotNull()).select("path", "error")
    # a derived table counts like an archive of its own
    lost = named.join(stored.select("table_name", "file_name"), ["table_name", "file_name"], "left_anti")
    shadowed = readable.join(lost, "file_name").select(
        "path", F.concat(F.lit("another archive has the same table name: "), "table_name").alias("error")
    )
    failed.unionByName(shadowed).write.parquet(f"{build}/ingest_errors")

    # packed archives are about as long as Parquet files of their rows
    buckets = layout.buckets_for(archives.agg(F.sum("length")).first()[0] or 0)

    # one job per table, as every sheet has columns of its own; a few run side by side
    sheets = stored.where(F.col("part") == "all").join(readable, "file_name")

    def write_table(row: Row) -> tuple[str, dict]:
        cells = staged.where(F.col("archive") == _archive_key(row["path"])).where(F.col("cells").isNotNull())
        table = typed_columns(cells, row["header"])
        return row["table_name"], _written(table, f"{build}/{row['table_name']}", buckets)

    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        facts = dict(pool.map(write_table, sheets.select("path", "header", "table_name").toLocalIterator()))
    for row in stored.where(F.col("part") != "all").toLocalIterator():
        facts[row["table_name"]] = _write_part(spark, build, row["table_name"], row["part"], buckets)
    published.drop_folder(spark, f"{build}/_cells")
    published.drop_folder(spark, f"{build}/_blocks")
    published.publish(spark, target, build, {"tables": facts})
    published.tidy(spark, target)
    return stored


def _written(table: DataFrame, path: str, buckets: int) -> dict:
    """Write a table by project; its rows and missing values per column, counted on the way, and its layout."""
    project = next(c for c, short in fv.PROJECT_COLUMNS.items() if short == "project_id")
    placed = layout.layout_of(table, project, buckets)
    seen = Observation()
    nulls = [F.count_if(F.col(layout.quoted(c)).isNull()).alias(f"n{i}") for i, c in enumerate(table.columns)]
    layout.write(table, path, placed, lambda rows: rows.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls))
    found = seen.get
    return {"rows": found["rows"], "nulls": {c: found[f"n{i}"] for i, c in enumerate(table.columns)}, "layout": placed.facts()}


def _staged_cells(archives: DataFrame, path: str, scratch: str) -> DataFrame:
    """The parsed archives as a written table, one folder per archive."""
    cells = read_archives(archives, scratch).withColumn("archive", F.concat(F.lit("a"), F.md5("path")))
    writer = cells.write.option("maxRecordsPerFile", ROWS_PER_FILE)
    writer.partitionBy("archive").parquet(path)
    return archives.sparkSession.read.parquet(path)


def _archive_key(path: str) -> str:
    return "a" + hashlib.md5(path.encode()).hexdigest()


def _write_part(spark: SparkSession, build: str, table_name: str, part: str, buckets: int) -> dict:
    suffix = fv.SUMMARY_TABLE_SUFFIX if part == "summary" else fv.DETAIL_TABLE_SUFFIX
    whole = spark.read.parquet(f"{build}/{table_name.removesuffix(suffix)}")
    amount = next(c for c, short in fv.SPEND_COLUMNS.items() if short == "amount")
    rows = whole.withColumn(amount, to_number(F.col(f"`{amount}`")))
    missing = F.col(f"`{amount}`").isNull()
    return _written(rows.where(missing if part == "summary" else ~missing), f"{build}/{table_name}", buckets)


@contextmanager
def _open(path: str):
    """A seekable file on local disk or on any store Arrow can reach."""
    uri = quote(path.replace("s3a://", "s3://", 1), safe=":/@")
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    filesystem, name = fs.FileSystem.from_uri(uri)
    with filesystem.open_input_file(name) as file:
        yield file
