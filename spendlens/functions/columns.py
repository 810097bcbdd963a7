"""Column helpers that pin down money, ratio, order and blank semantics."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(38,10)"  # sums up to 1e28 with ten decimals, whatever the order of the rows
NUMBER_PATTERN = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"


def money_sum(column: str | Column) -> Column:
    """Order-independent sum of a double column: decimal inside, double outside."""
    return F.sum(_col(column).cast(MONEY)).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, NULL where whole is zero or either side is NULL."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * F.lit(100.0)


def blank(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == "")


def zero_or_null(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)) == 0


def contains_any(column: str, words: Iterable[str]) -> Column:
    """OR-chain of substring tests; false when no word is given."""
    tests = [F.col(column).contains(word) for word in words]
    return reduce(Column.__or__, tests, F.lit(False))


def first_desc(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def first_asc(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def identity_text(df: DataFrame, columns: Sequence[str], extra: Sequence[Column] = ()) -> Column:
    """The values as one text, the same wherever it is computed.

    Missing values keep their place, and doubles are written as plain decimals.
    """
    types = dict(df.dtypes)
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        if types[name] in ("double", "float"):
            text = F.coalesce(F.col(name).try_cast("decimal(38,6)").cast("string"), text)
        parts.append(F.coalesce(text, F.lit("\u0002")))
    return F.concat_ws("\u0001", *parts, *[c.cast("string") for c in extra])


def to_number(column: str | Column) -> Column:
    """Text to double; anything that is not a plain decimal number gives NULL."""
    text = F.trim(_col(column).cast("string"))
    plain = text.rlike("^" + NUMBER_PATTERN + "$")
    return F.when(plain, text.try_cast("double"))


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
