"""The registered queries on tables where a third of the rows share a key or are copies."""

import duckdb
import pytest

from spendlens.plans import oracle, registry
from spendlens.plans.fixtures import BASE_TABLES
from tests.conftest import SF_DIR
from tests.test_queries import rows

QUERIES = registry.queries()
SQL = oracle.oracle_sql()
HEAVY = (
    "over_budget_cause", "spend_vs_budget_rows", "spend_vs_budget_grouped", "reconcile_detail_breakdown",
    "reconcile_summary_detail", "lookup_detail", "related_to_top_project", "keyword_projects", "ministry_summary",
    "text_sample", "table_catalog", "dq_report", "project_dossier", "dossier_flatten", "agent_flow", "rag_documents",
    "vector_store_rows", "audit_sample_ministry",
)


@pytest.fixture(scope="module")
def hot(tmp_path_factory):
    """One project owns a third of orders and events, a third of the payments are copies of one."""
    folder = tmp_path_factory.mktemp("hot")
    con = duckdb.connect()
    for table in BASE_TABLES:
        source = f"'{SF_DIR}/{table}.parquet'"
        sql = f"SELECT * FROM {source}"
        if table == "orders":
            sql = f"SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey) FROM {source}"
        if table == "events":
            sql = f"SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id) FROM {source}"
        if table == "part":
            sql = f"SELECT * REPLACE (CASE WHEN p_partkey % 3 = 0 THEN 'red widget' ELSE p_name END AS p_name) FROM {source}"
        if table == "lineitem":
            one = f"(SELECT * FROM {source} WHERE l_orderkey = 3 AND l_linenumber < 6 ORDER BY ALL LIMIT 1)"
            sql += f" UNION ALL SELECT x.* FROM {one} x, range((SELECT COUNT(*) // 2 FROM {source}))"
        con.execute(f"COPY ({sql}) TO '{folder}/{table}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    yield str(folder), con
    con.close()


@pytest.mark.parametrize("name", HEAVY)
def test_same_rows_on_hot_tables(spark, hot, name):
    folder, con = hot
    df = QUERIES[name](spark, folder)
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    want = rows(columns, result.fetchall())
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    assert got == want and got
