"""Views over the given tables in the shape of the spending tables.

One text serves Spark and the SQL check: a project is a customer, a ministry
its market segment, a budget row an order, a payment a line item and a payee
a supplier.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from spendlens.sources import layout
from spendlens.sources.published import scratch, stored

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS = {
    "fx_budget": """
        SELECT o.o_custkey AS project_id, c.c_name AS project_name, CAST(year(o.o_orderdate) AS INT) AS fiscal_year, o.o_orderpriority AS account_class,
        CASE WHEN o.o_orderstatus='F' THEN o.o_totalprice END AS initial_amt,
        CASE WHEN o.o_orderstatus='P' AND o.o_orderpriority='5-LOW' THEN -o.o_totalprice WHEN o.o_orderstatus='P' THEN o.o_totalprice END AS supplementary_amt,
        CASE WHEN o.o_orderstatus='O' AND o.o_orderpriority<>'4-NOT SPECIFIED' THEN o.o_totalprice END AS carryover_amt,
        CAST(0 AS DOUBLE) AS reserve_amt,
        CASE WHEN o.o_orderstatus='P' AND o.o_orderpriority='5-LOW' THEN -o.o_totalprice WHEN o.o_orderstatus='O' AND o.o_orderpriority='4-NOT SPECIFIED' THEN NULL ELSE o.o_totalprice END AS total_amt,
        CASE WHEN o.o_orderstatus='F' THEN o.o_totalprice*0.95 WHEN o.o_orderstatus='P' THEN o.o_totalprice*0.5 END AS executed_amt,
        CASE WHEN o.o_orderstatus='F' THEN CAST(95 AS DOUBLE) WHEN o.o_orderstatus='P' THEN CAST(50 AS DOUBLE) END AS execution_rate
        FROM orders o
        JOIN customer c ON o.o_custkey=c.c_custkey
    """,
    "fx_spend": """
        SELECT o.o_custkey AS project_id, c.c_name AS project_name, c.c_mktsegment AS ministry, concat(l.l_returnflag,l.l_linestatus) AS block_no,
        CASE WHEN l.l_linenumber=7 THEN l.l_extendedprice END AS block_total,
        CASE WHEN l.l_linenumber=6 AND l.l_discount>CAST(0.08 AS DOUBLE) THEN NULL ELSE s.s_name END AS payee,
        CASE WHEN l.l_suppkey%10=0 THEN NULL ELSE l.l_suppkey END AS corp_no,
        CASE WHEN l.l_partkey%9=0 THEN NULL ELSE p.p_name END AS outline,
        CASE WHEN l.l_linenumber=7 THEN NULL WHEN l.l_partkey%101=0 THEN CAST(0 AS DOUBLE) WHEN l.l_partkey%97=0 THEN -l.l_extendedprice ELSE l.l_extendedprice END AS amount,
        CASE WHEN l.l_partkey%18=0 THEN '' ELSE p.p_type END AS method,
        CASE WHEN l.l_linenumber=7 AND l.l_partkey%6<>0 THEN p.p_brand END AS role,
        CASE WHEN l.l_partkey%101=0 AND l.l_linenumber<>7 THEN CAST(0 AS DOUBLE) WHEN l.l_linenumber=5 THEN l.l_extendedprice END AS payee_total, l.l_discount AS bid_rate
        FROM lineitem l
        JOIN orders o ON l.l_orderkey=o.o_orderkey
        JOIN customer c ON o.o_custkey=c.c_custkey
        JOIN supplier s ON l.l_suppkey=s.s_suppkey
        JOIN part p ON l.l_partkey=p.p_partkey
    """,
    "fx_org": """
        SELECT c_custkey AS project_id, c_name AS project_name, c_mktsegment AS ministry, 0 AS other_no
        FROM customer
        UNION ALL SELECT c_custkey, c_name, c_mktsegment, 1
        FROM customer
        WHERE c_custkey%5=0
    """,
    "fx_overview": """
        SELECT c.c_custkey AS project_id, c.c_name AS project_name, c.c_mktsegment AS ministry,
        CASE WHEN c.c_custkey%17=0 THEN '' ELSE p.p_name END AS purpose, p.p_type AS outline
        FROM customer c
        JOIN part p ON c.c_custkey=p.p_partkey
    """,
    "fx_obligation": """
        SELECT o_custkey AS project_id, o_totalprice AS contract_amt
        FROM orders
        WHERE o_orderpriority='1-URGENT' AND o_orderstatus='P'
    """,
    "fx_remarks": """
        SELECT o_custkey AS project_id, o_orderkey AS remark_no, o_orderpriority AS remark
        FROM orders
        WHERE o_orderstatus='P'
    """,
    "fx_block_edges": """
        SELECT project_id, block_no AS dst_block,
        CASE WHEN substr(block_no,1,1)='A' THEN NULL ELSE concat('A',substr(block_no,2,1)) END AS src_block, substr(block_no,1,1)='A' AS from_ministry
        FROM (SELECT DISTINCT project_id, block_no
        FROM fx_spend) q
    """,
    "fx_related": """
        SELECT user_id AS project_id, event_id AS related_id, event_type AS relation
        FROM events
        UNION ALL SELECT o_custkey, o_orderkey, o_orderpriority
        FROM orders
    """,
    "fx_spend_summary": """
        SELECT *
        FROM fx_spend
        WHERE amount IS NULL
    """,
    "fx_spend_detail": """
        SELECT *
        FROM fx_spend
        WHERE amount IS NOT NULL
    """,
    "fx_breakdown": """
        SELECT project_id, block_no, payee, corp_no, outline,
        CASE WHEN bid_rate>CAST(0.05 AS DOUBLE) THEN amount-10 ELSE amount END AS amount
        FROM fx_spend_detail
    """,
}


def load(
    spark: SparkSession, sf_dir: str, *names: str, payments: Sequence[str] | None = None, buckets: int | None = None
) -> list[DataFrame]:
    """The named views (or given tables) over the Parquet files in ``sf_dir``.

    Views that build on the same table share one reading of it. With ``payments`` these columns of ``fx_spend`` are
    written once, and all views above it read them there: for queries that would make its joins several times. With
    ``buckets`` they lie in so many buckets of the project, for queries that gather several views by project.
    """
    frames: dict[str, DataFrame] = {}
    if payments is not None:
        frames["fx_spend"] = stored(_frame(spark, sf_dir, "fx_spend", {}).select(*payments), "payments")
        if buckets:
            place = scratch(spark, f"payments-{uuid.uuid4().hex}")
            frames["fx_spend"] = layout.stored_by(frames["fx_spend"], "project_id", buckets, place)
    return [_frame(spark, sf_dir, name, frames) for name in names]


def _frame(spark: SparkSession, sf_dir: str, name: str, frames: dict[str, DataFrame]) -> DataFrame:
    if name not in frames:
        if name in BASE_TABLES:
            frames[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        else:
            inputs = [t for t in (*BASE_TABLES, *VIEWS) if t != name and _mentions(VIEWS[name], t)]
            # the frames are passed by name, so no temp view of the session is touched
            text = re.sub(r"\b(FROM|JOIN)\s+(\w+)", r"\1 {\2}", _customers_first(VIEWS[name]))
            frames[name] = spark.sql(text, **{t: _frame(spark, sf_dir, t, frames) for t in inputs})
    return frames[name]


def _customers_first(text: str) -> str:
    """The same joins with orders and customers joined before the line items meet them.

    Spark keeps the written order; this one shuffles the few orders by customer, not the many line items.
    """
    orders, customers = "JOIN orders o ON l.l_orderkey=o.o_orderkey", "JOIN customer c ON o.o_custkey=c.c_custkey"
    first = "JOIN (SELECT * FROM orders JOIN customer ON o_custkey=c_custkey) oc ON l.l_orderkey=oc.o_orderkey"
    if orders not in text:
        return text
    text = re.sub(rf"{re.escape(orders)}\s+{re.escape(customers)}", first, text)
    return re.sub(r"\b[oc]\.(?=[oc]_)", "oc.", text)


def sql_with_views(sql: str) -> str:
    """Put the definitions of all views that ``sql`` uses in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for view in VIEWS:
            if view not in needed and _mentions(text, view):
                visit(VIEWS[view])
                if view not in needed:
                    needed.append(view)

    visit(sql)
    if not needed:
        return sql
    body = re.sub(r"^\s*WITH\s+", "", sql, flags=re.I)
    joiner = ",\n" if body != sql else "\n"
    return "WITH " + ",\n".join(f"{v} AS ({VIEWS[v]})" for v in needed) + joiner + body


def _mentions(text: str, name: str) -> bool:
    return re.search(rf"\b{name}\b", text) is not None
