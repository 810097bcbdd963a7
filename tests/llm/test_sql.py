"""Registered queries against their SQL on the same tables."""

import pytest

from spendlens.llm import queries
from tests.conftest import SF_DIR


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_same_rows(spark, duck, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    result = duck.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)

    def ordered(rows, names):
        at = sorted(range(len(names)), key=lambda i: names[i])
        return sorted((tuple(r[i] for i in at) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))

    got, want = ordered(df.collect(), df.columns), ordered(result.fetchall(), columns)
    assert got and got == want


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLE_SQL])
def test_whole_result(spark, name):
    rows = queries.QUERIES[name](spark, SF_DIR)
    table = {"op6": "pages", "op12": "embeddings"}.get(name.split("_")[0], "documents")
    n = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    if table == "embeddings":
        n = 10 * spark.read.parquet(f"{SF_DIR}/{table}.parquet").where("vec_id % 100 = 0").count()
    assert rows.count() == (n if not name.startswith("op10") else rows.select("source", "lang", "tokenizer").distinct().count())
