"""Reconciliation: block totals with details, contract amounts with breakdowns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.functions.columns import first_asc, first_desc, money_sum, to_number
from spendlens.operators.skew import COPIES, collapse, expand_sorted, spread_join


def split_summary(spend: DataFrame) -> DataFrame:
    """Rows whose amount is missing or not a number."""
    return spend.withColumn("amount", to_number("amount")).where(F.col("amount").isNull())


def split_detail(spend: DataFrame) -> DataFrame:
    """Rows with a numeric amount."""
    return spend.withColumn("amount", to_number("amount")).where(F.col("amount").isNotNull())


def reconcile_summary_detail(
    summary: DataFrame, detail: DataFrame, org: DataFrame, tolerance: float = 1.0
) -> DataFrame:
    """Blocks whose summary total and detail sum differ by more than the tolerance."""
    blocks = ["project_id", "block_no"]
    totals = (
        summary.where(F.col("block_total").isNotNull())
        .groupBy(*blocks)
        .agg(money_sum("block_total").alias("summary_total"))
    )
    sums = detail.groupBy(*blocks).agg(money_sum("amount").alias("detail_sum"))
    gaps = (
        totals.join(sums, blocks)
        .withColumn("gap", F.col("summary_total") - F.col("detail_sum"))
        .where(F.abs("gap") > tolerance)
    )
    named = _named(gaps, org).select(
        "project_id", "project_name", "block_no", "summary_total", "detail_sum", "gap", COPIES
    )
    return expand_sorted(named, [F.abs("gap").desc_nulls_last(), *first_asc("project_id", "block_no")])


def reconcile_detail_breakdown(
    detail: DataFrame, breakdown: DataFrame, org: DataFrame, tolerance: float = 1.0
) -> DataFrame:
    """Contracts whose amount and breakdown sum differ by more than the tolerance.

    Corporate number and outline also match when both are missing. The contract
    rows are shuffled once, for the join; what is left after the tolerance is
    folded before the names and the sort.
    """
    exact, null_safe = ["project_id", "block_no", "payee"], ["corp_no", "outline"]
    keys = [*exact, *null_safe]
    contracts = detail.where(F.col("amount").isNotNull()).select(*keys, "amount")
    sums = (
        breakdown.where(F.col("amount").isNotNull())
        .groupBy(*keys)
        .agg(money_sum("amount").alias("breakdown_sum"))
    )
    gaps = (
        spread_join(contracts, sums, exact, null_safe=null_safe)
        .withColumn("gap", F.col("amount") - F.col("breakdown_sum"))
        .where(F.abs("gap") > tolerance)
    )
    folded = collapse(gaps, ["project_id", "payee", "outline", "amount", "breakdown_sum", "gap"])
    named = _named(folded, org).select(
        "project_id",
        "project_name",
        "payee",
        "outline",
        F.col("amount").alias("contract_amount"),
        "breakdown_sum",
        "gap",
        COPIES,
    )
    order = first_asc("project_id", "payee", "outline")
    return expand_sorted(named, [F.abs("gap").desc_nulls_last(), *order, *first_desc("contract_amount")])


def _named(rows: DataFrame, org: DataFrame) -> DataFrame:
    """Left join the project names; ``copies`` counts one row per organisation row of the project."""
    names = collapse(org, ["project_id", "project_name"], "_org_copies")
    times = F.coalesce("_org_copies", F.lit(1))
    if COPIES in rows.columns:
        times = times * F.col(COPIES)
    joined = spread_join(rows, names, ["project_id"], "left")
    return joined.withColumn(COPIES, times).drop("_org_copies")
