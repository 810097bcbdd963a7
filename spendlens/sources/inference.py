"""Column types from whole columns of text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.functions.columns import NUMBER_PATTERN, to_number

TRUE_FALSE = ("True", "TRUE", "true", "False", "FALSE", "false")

# what a text cell can be, one bit each
MISSING, WHOLE, NUMBER, TRUTH, TEXT = 1, 2, 4, 8, 16


def inferred_types(df: DataFrame) -> DataFrame:
    """(position, column_name, column_type, notnull, pk): one row per text column.

    One pass. A column is BIGINT when every row is a whole number, DOUBLE when
    all values are numbers (also whole numbers with gaps, and columns without
    any value), BOOLEAN when all values are true or false, else VARCHAR.
    """
    seen = [
        F.struct(F.lit(position).alias("position"), F.lit(name).alias("column_name"), _kinds(name).alias("kinds"))
        for position, name in enumerate(df.columns)
    ]
    rows = df.agg(F.array(*seen).alias("columns")).select(F.explode("columns").alias("c")).select("c.*")
    kinds = F.col("kinds")
    column_type = (
        F.when(kinds == WHOLE, "BIGINT")
        .when(kinds.bitwiseAND(F.lit(TRUTH | TEXT)) == 0, "DOUBLE")
        .when(kinds.bitwiseAND(F.lit(WHOLE | NUMBER | TEXT)) == 0, "BOOLEAN")
        .otherwise("VARCHAR")
    )
    return rows.select(
        "position",
        "column_name",
        column_type.alias("column_type"),
        F.lit(False).alias("notnull"),
        F.lit(False).alias("pk"),
    )


def _kinds(name: str) -> Column:
    """The bits of all kinds of cells in a column; one expression, as sheets have many columns."""
    cell = "`" + name.replace("`", "``") + "`"
    return F.expr(
        rf"""coalesce(bit_or(CASE
            WHEN {cell} IS NULL THEN {MISSING}
            WHEN {cell} RLIKE r'^\s*[+-]?\d+\s*$'
                AND (length({cell}) < 18 OR try_cast(trim({cell}) AS BIGINT) IS NOT NULL) THEN {WHOLE}
            WHEN {cell} RLIKE r'^\s*{NUMBER_PATTERN}\s*$' THEN {NUMBER}
            WHEN {cell} IN {TRUE_FALSE} THEN {TRUTH}
            ELSE {TEXT} END), 0)"""
    )


def typed_columns(cells: DataFrame, header: Sequence[str]) -> DataFrame:
    """The text cells of one sheet as columns of inferred type.

    The types are read back to build the plan: one row per column.
    """
    text = cells.select(*[F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(header)])
    types = {r["column_name"]: r["column_type"] for r in inferred_types(text).toLocalIterator()}
    return text.select(*[_convert(name, types[name]).alias(name) for name in header])


def _convert(name: str, kind: str) -> Column:
    text = F.col("`" + name.replace("`", "``") + "`")
    if kind == "BIGINT":
        return F.trim(text).try_cast("bigint")
    if kind == "DOUBLE":
        return to_number(text)
    if kind == "BOOLEAN":
        return F.lower(text).try_cast("boolean")
    return text


def as_text(df: DataFrame) -> DataFrame:
    """All columns as text, the form in which sheets arrive."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
