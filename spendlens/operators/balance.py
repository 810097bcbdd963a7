"""Budgets against payments: totals, shares, over-budget checks, execution rates.

Both sides are summed by project before they meet, so a project with many rows
costs partial aggregates, not a long list in one task. Budget sums run over all
years unless a year is given; projects without payments drop out of every
comparison (inner join).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.functions import fixed_values as fv
from spendlens.functions.columns import first_asc, first_desc, money_sum, percent, ratio
from spendlens.operators.skew import COPIES, collapse, expand, expand_sorted, spread_join

BUDGET_PARTS = ("initial_amt", "supplementary_amt", "carryover_amt", "reserve_amt")


def total_budget(budget: DataFrame) -> DataFrame:
    return budget.agg(money_sum("total_amt").alias("total_budget"))


def total_spend(breakdown: DataFrame) -> DataFrame:
    return breakdown.where(F.col("amount").isNotNull()).agg(money_sum("amount").alias("total_spend"))


def spend_by_project(spend: DataFrame) -> DataFrame:
    return (
        spend.where(F.col("amount").isNotNull())
        .groupBy("project_id")
        .agg(money_sum("amount").alias("spend_total"))
    )


def budget_by_project(budget: DataFrame) -> DataFrame:
    """Budget per project and name; a renamed project gives one row per name."""
    return budget.groupBy("project_id", "project_name").agg(money_sum("total_amt").alias("budget_total"))


def top_budget_project(budget: DataFrame) -> DataFrame:
    return (
        budget.where(F.col("total_amt").isNotNull())
        .groupBy("project_id", "project_name")
        .agg(money_sum("total_amt").alias("budget_total"))
        .orderBy(*first_desc("budget_total"), *first_asc("project_id", "project_name"))
        .limit(1)
    )


def spend_vs_budget_rows(budget: DataFrame, spend: DataFrame) -> DataFrame:
    """Every payment row beside the budget of its project: rows, sum, share of the sum.

    For all projects at once each payment meets one budget row, not all of
    them; ``spend_vs_budget_pairs`` shows the pairs of one project.
    """
    budgets = (
        budget.where(F.col("total_amt").isNotNull())
        .groupBy("project_id")
        .agg(F.count(F.lit(1)).alias("budget_rows"), money_sum("total_amt").alias("budget_total"))
    )
    payments = spend.select("project_id", "project_name", "block_no", "payee", "amount")
    # folded where the join has put them, so the payments are shuffled once before the sort
    met = spread_join(payments, budgets, ["project_id"], keep_hash="_project")
    joined = collapse(met, met.columns).drop("_project").withColumn(
        "budget_pct", percent(F.col("amount"), F.col("budget_total"))
    ).select(*payments.columns, COPIES, "budget_rows", "budget_total", "budget_pct")
    return expand_sorted(
        joined, [*first_desc("amount"), *first_asc("project_id", "project_name", "block_no", "payee")]
    )


def spend_vs_budget_pairs(budget: DataFrame, spend: DataFrame, project_id: int) -> DataFrame:
    """Every budget row of one project beside every payment row of it, with the share."""
    budgets = collapse(
        budget.where(F.col("project_id") == project_id), ["project_id", "project_name", "total_amt"], "budget_copies"
    )
    payments = collapse(
        spend.where(F.col("project_id") == project_id), ["project_id", "block_no", "payee", "amount"], "spend_copies"
    )
    pairs = spread_join(payments, budgets, ["project_id"]).select(
        "project_name",
        "total_amt",
        "block_no",
        "payee",
        "amount",
        percent(F.col("amount"), F.col("total_amt")).alias("budget_pct"),
        (F.col("budget_copies") * F.col("spend_copies")).alias(COPIES),
    )
    return expand_sorted(pairs, [*first_desc("amount"), *first_asc("total_amt", "block_no", "payee")])


def spend_vs_budget_grouped(budget: DataFrame, spend: DataFrame, project_id: int | None = None) -> DataFrame:
    """Budget sum per project beside the sum per payee, with the share."""
    if project_id is not None:
        budget = budget.where(F.col("project_id") == project_id)
        spend = spend.where(F.col("project_id") == project_id)
    budgets = budget_by_project(budget.where(F.col("total_amt").isNotNull()))
    payees = (
        spend.where(F.col("amount").isNotNull())
        .groupBy("project_id", "payee")
        .agg(money_sum("amount").alias("payee_spend"))
    )
    return (
        spread_join(payees, budgets, ["project_id"])
        .select(
            "project_id",
            "project_name",
            "budget_total",
            "payee",
            "payee_spend",
            percent(F.col("payee_spend"), F.col("budget_total")).alias("budget_pct"),
        )
        .orderBy(*first_desc("payee_spend"), *first_asc("project_id", "project_name", "payee"))
    )


def _over_budget(budgets: DataFrame, spend: DataFrame) -> DataFrame:
    return (
        budgets.join(spend_by_project(spend), "project_id")
        .where(F.col("spend_total") > F.col("budget_total"))
        .withColumn("excess", F.col("spend_total") - F.col("budget_total"))
    )


def over_budget(budget: DataFrame, spend: DataFrame) -> DataFrame:
    """Projects that spent more than their budget, with the four budget parts."""
    sums = [money_sum("total_amt").alias("budget_total")]
    sums += [money_sum(part).alias(part.replace("_amt", "_total")) for part in BUDGET_PARTS]
    budgets = budget.groupBy("project_id", "project_name").agg(*sums)
    parts = [part.replace("_amt", "_total") for part in BUDGET_PARTS]
    return (
        _over_budget(budgets, spend)
        .select("project_id", "project_name", "budget_total", "spend_total", "excess", *parts)
        .orderBy(*first_desc("excess"), *first_asc("project_id", "project_name"))
    )


def over_budget_by_year(budget: DataFrame, spend: DataFrame, year: int = 2024) -> DataFrame:
    """The same against the budget of one year; payments carry no year."""
    budgets = budget_by_project(budget.where(F.col("fiscal_year") == year))
    return (
        _over_budget(budgets, spend)
        .select("project_id", "project_name", "budget_total", "spend_total", "excess")
        .orderBy(*first_desc("excess"), *first_asc("project_id", "project_name"))
    )


def over_budget_cause(budget: DataFrame, spend: DataFrame, obligation: DataFrame) -> DataFrame:
    """Over-budget projects with the first cause that applies."""
    issues = _over_budget(budget_by_project(budget), spend)
    obliged = obligation.select("project_id").distinct().withColumn("has_obligation", F.lit(True))
    negative = (
        budget.where(reduce(Column.__or__, [F.col(part) < 0 for part in BUDGET_PARTS]))
        .select("project_id")
        .distinct()
        .withColumn("has_negative_part", F.lit(True))
    )
    cause = (
        F.when(F.col("has_obligation"), fv.CAUSE_OBLIGATION)
        .when(F.col("has_negative_part"), fv.CAUSE_NEGATIVE_PART)
        .when(F.col("budget_total") == 0, fv.CAUSE_ZERO)
        .when(F.col("budget_total") < 0, fv.CAUSE_NEGATIVE_TOTAL)
        .otherwise(fv.CAUSE_UNKNOWN)
    )
    return (
        issues.join(obliged, "project_id", "left")
        .join(negative, "project_id", "left")
        .select(
            "project_id", "project_name", "budget_total", "spend_total", "excess", cause.alias("cause")
        )
    )


def over_budget_cause_counts(causes: DataFrame) -> DataFrame:
    return (
        causes.where(F.col("cause").isNotNull())
        .groupBy("cause")
        .agg(F.count(F.lit(1)).alias("projects"))
        .orderBy(*first_desc("projects"), *first_asc("cause"))
    )


def execution_rates(budget: DataFrame, org: DataFrame) -> DataFrame:
    """Executed share of the budget per project, one row per organisation row."""
    totals = budget.groupBy("project_id", "project_name").agg(
        money_sum("total_amt").alias("budget_total"), money_sum("executed_amt").alias("executed_total")
    )
    ministries = collapse(org, ["project_id", "ministry"])
    joined = totals.join(ministries, "project_id", "left").withColumn(COPIES, F.coalesce(COPIES, F.lit(1)))
    return expand(joined, spread=True).select(
        "project_id",
        "project_name",
        "ministry",
        "budget_total",
        "executed_total",
        percent(F.col("executed_total"), F.col("budget_total")).alias("rate_pct"),
    )


def _rates(budget: DataFrame, spend: DataFrame) -> DataFrame:
    """Declared rate (weighted by budget) beside the rate computed from payments."""
    weighted = budget.where(
        F.col("total_amt").isNotNull() & (F.col("total_amt") != 0) & F.col("execution_rate").isNotNull()
    )
    declared = weighted.groupBy("project_id", "project_name").agg(
        money_sum("total_amt").alias("budget_total"),
        money_sum(F.col("execution_rate") * F.col("total_amt")).alias("_weighted"),
    )
    return (
        declared.join(spend_by_project(spend), "project_id")
        .withColumn("declared_rate", ratio(F.col("_weighted"), F.col("budget_total")))
        .withColumn("computed_rate", percent(F.col("spend_total"), F.col("budget_total")))
        .withColumn("rate_gap", F.abs(F.col("declared_rate") - F.col("computed_rate")))
        .select(
            "project_id",
            "project_name",
            "declared_rate",
            "computed_rate",
            "rate_gap",
            "budget_total",
            "spend_total",
        )
    )


def rate_gap_top(budget: DataFrame, spend: DataFrame, n: int = 100) -> DataFrame:
    """The n projects whose two rates differ most."""
    rates = _rates(budget, spend)
    return rates.orderBy(*first_desc("rate_gap"), *first_asc("project_id", "project_name")).limit(n)


def rate_match_top(
    budget: DataFrame, spend: DataFrame, min_budget: float = 100_000_000, n: int = 100
) -> DataFrame:
    """The n projects over ``min_budget`` whose two rates agree best."""
    rates = _rates(budget, spend).where(F.col("budget_total") > min_budget)
    return rates.orderBy(*first_asc("rate_gap", "project_id", "project_name")).limit(n)


def within_budget_ids(budget: DataFrame, spend: DataFrame) -> DataFrame:
    totals = budget.groupBy("project_id").agg(money_sum("total_amt").alias("budget_total"))
    return (
        totals.join(spend_by_project(spend), "project_id")
        .where(F.col("spend_total") <= F.col("budget_total"))
        .select("project_id")
    )


def obligation_within_budget(budget: DataFrame, spend: DataFrame, obligation: DataFrame) -> DataFrame:
    """Projects inside their budget that still have a multi-year obligation."""
    return within_budget_ids(budget, spend).intersect(obligation.select("project_id"))


def obligation_counts(budget: DataFrame, spend: DataFrame, obligation: DataFrame) -> DataFrame:
    """One row: projects within budget, with obligation, both, and whether none is both."""
    within = within_budget_ids(budget, spend).select("project_id", F.lit(1).alias("w"), F.lit(0).alias("o"))
    obliged = obligation.select("project_id", F.lit(0).alias("w"), F.lit(1).alias("o"))
    per_project = within.unionByName(obliged).groupBy("project_id").agg(F.max("w").alias("w"), F.max("o").alias("o"))
    counts = per_project.agg(
        F.coalesce(F.sum("w"), F.lit(0)).alias("within_budget"),
        F.coalesce(F.sum("o"), F.lit(0)).alias("with_obligation"),
        F.coalesce(F.sum(F.col("w") * F.col("o")), F.lit(0)).alias("exceptions"),
    )
    return counts.withColumn("holds", F.col("exceptions") == 0)
