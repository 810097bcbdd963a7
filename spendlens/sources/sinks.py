"""Writing and reading results: Parquet, CSV, JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BOM = "\ufeff"


def write_parquet(df: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    """Replace the table at ``path``; ``rows_per_file`` bounds the files."""
    writer = df.write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, bom: bool = True) -> None:
    """CSV files with a header, UTF-8, with a byte-order mark unless told otherwise.

    Every task writes its own file. With a mark the header's first name starts
    with it, so each file starts with the three bytes spreadsheets look for.
    """
    names = list(df.columns)
    if bom and names:
        df = df.withColumnRenamed(names[0], BOM + names[0])
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per row, UTF-8, missing values kept as null."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_json_text(df: DataFrame, column: str, path: str) -> None:
    """A column that holds JSON already, one text per line."""
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON file that may span lines, as nested columns."""
    return spark.read.option("multiLine", True).json(path)
