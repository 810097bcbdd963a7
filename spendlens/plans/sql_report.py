"""Run SQL text as users write it for the spending views, and save the result."""

from __future__ import annotations

import re
from collections.abc import Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from spendlens.sources.sinks import write_csv

DOUBLE_QUOTES = "spark.sql.ansi.doubleQuotedIdentifiers"
STRING_OR_COMMENT = r"""'(?:[^']|'')*'|"(?:[^"]|"")*"|`[^`]*`|--[^\n]*|/\*.*?\*/"""
BARE_NAME = "([A-Za-z_\u00a1-\u2fff\u3001-\U0010ffff][\\w$\u00a1-\u2fff\u3001-\U0010ffff]*)"


def quote_names(text: str) -> str:
    """Put double quotes around bare names with letters outside ASCII, which Spark SQL asks for."""

    def quoted(match: re.Match[str]) -> str:
        word = match.group()
        return word if match.group(1) is None or word.isascii() else f'"{word}"'

    return re.sub(STRING_OR_COMMENT + "|" + BARE_NAME, quoted, text, flags=re.S)


def run_sql(
    spark: SparkSession,
    text: str,
    args: Mapping[str, Any] | None = None,
    views: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The result of a SQL text over the registered views, lazily.

    Names may stand in double quotes, and names in other scripts also without.
    ``:name`` in the text takes its value from ``args``; values are bound, never
    put into the text. ``views`` are known under their names to this text only;
    views the session has under these names are as before afterwards.
    """
    before = spark.conf.get(DOUBLE_QUOTES)
    hidden = {}
    spark.conf.set(DOUBLE_QUOTES, "true")
    try:
        for name, view in (views or {}).items():
            hidden[name] = spark.table(_quoted(name)) if spark.catalog.tableExists(_quoted(name)) else None
            view.createOrReplaceTempView(_quoted(name))
        return spark.sql(quote_names(text), args=dict(args or {}))
    finally:
        spark.conf.set(DOUBLE_QUOTES, before)
        for name, earlier in hidden.items():
            spark.catalog.dropTempView(name)
            if earlier is not None:
                earlier.createOrReplaceTempView(_quoted(name))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def run_sql_file(
    spark: SparkSession, query_file: str, output: str | None = None, args: Mapping[str, Any] | None = None
) -> DataFrame:
    """Run a ``.sql`` file; with ``output`` also write the result as CSV with a BOM."""
    result = run_sql(spark, Path(query_file).read_text(encoding="utf-8"), args)
    if output:
        write_csv(result, output)
    return result
