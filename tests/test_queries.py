"""Every registered query against its SQL on the same Parquet tables."""

import math
import re

import pytest

import __spark_entry__ as entry
from spendlens.plans import oracle, registry
from spendlens.plans.fixtures import VIEWS
from tests.conftest import SF_DIR

QUERIES = registry.queries()
SQL = oracle.oracle_sql()


def canonical(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(canonical(t[i]) for i in order) for t in tuples]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(SQL[name])
    columns = [d[0] for d in result.description]
    want = rows(columns, result.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert len(got) == len(want)
    assert got == want
    assert got


def test_queries_take_whole_tables():
    """No query text of the views cuts tables down."""
    assert not any(re.search(r"\blimit\b|sample", text, re.I) for text in VIEWS.values())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
