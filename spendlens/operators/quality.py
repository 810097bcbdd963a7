"""Seven data-quality rules and their report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.functions import fixed_values as fv
from spendlens.functions.columns import blank, money_sum, zero_or_null
from spendlens.operators.lookup import value_counts


def _spend_rules() -> dict[str, tuple[Column, tuple[str, ...]]]:
    """Rules on a single payment row: name, condition, columns shown besides the project."""
    has_amount = F.col("amount").isNotNull() & (F.col("amount") != 0)
    no_block_total = zero_or_null("block_total")
    return {
        fv.RULE_PAYEE_BLANK: (has_amount & blank("payee"), ("block_no", "amount", "outline")),
        fv.RULE_CONTRACT_BLANK: (has_amount & blank("method") & blank("outline"), ("payee", "amount")),
        fv.RULE_NEGATIVE: (F.col("amount") < 0, ("payee", "amount", "outline")),
        fv.RULE_NO_AMOUNT: (
            zero_or_null("amount") & no_block_total & zero_or_null("payee_total"),
            ("block_no", "payee"),
        ),
        fv.RULE_ROLE_BLANK: (
            zero_or_null("amount") & blank("role") & ~no_block_total,
            ("block_no", "block_total"),
        ),
    }


def spend_rule(spend: DataFrame, rule: str) -> DataFrame:
    """Payments that break one rule."""
    condition, columns = _spend_rules()[rule]
    return spend.where(condition).select(F.lit(rule).alias("rule"), "project_id", "project_name", *columns)


def payee_blank(spend: DataFrame) -> DataFrame:
    return spend_rule(spend, fv.RULE_PAYEE_BLANK)


def contract_blank(spend: DataFrame) -> DataFrame:
    return spend_rule(spend, fv.RULE_CONTRACT_BLANK)


def negative_amount(spend: DataFrame) -> DataFrame:
    return spend_rule(spend, fv.RULE_NEGATIVE)


def no_amount(spend: DataFrame) -> DataFrame:
    return spend_rule(spend, fv.RULE_NO_AMOUNT)


def role_blank(spend: DataFrame) -> DataFrame:
    return spend_rule(spend, fv.RULE_ROLE_BLANK)


def purpose_blank(overview: DataFrame) -> DataFrame:
    return overview.where(blank("purpose")).select(
        F.lit(fv.RULE_PURPOSE_BLANK).alias("rule"), "project_id", "project_name", "ministry"
    )


def budget_not_positive(budget: DataFrame) -> DataFrame:
    return (
        budget.groupBy("project_id", "project_name")
        .agg(money_sum("total_amt").alias("budget_total"))
        .where(F.col("budget_total") <= 0)
        .select(F.lit(fv.RULE_BUDGET_NOT_POSITIVE).alias("rule"), "project_id", "project_name", "budget_total")
    )


def quality_report(spend: DataFrame, overview: DataFrame, budget: DataFrame) -> DataFrame:
    """Rows of all seven rules in one frame; columns a rule does not show are NULL.

    The payments are read once: a payment yields one row per rule it breaks,
    instead of one scan per rule.
    """
    rules = _spend_rules()
    broken = F.array_compact(F.array(*[F.when(test, F.lit(rule)) for rule, (test, _) in rules.items()]))

    def shown(column: str) -> Column:
        names = [rule for rule, (_, columns) in rules.items() if column in columns]
        return F.when(F.col("rule").isin(names), F.col(column)).alias(column)

    payments = (
        spend.withColumn("_broken", broken)
        .where(F.size("_broken") > 0)
        .withColumn("rule", F.explode("_broken"))
        .select(
            "rule",
            "project_id",
            "project_name",
            *[shown(c) for c in ("block_no", "payee", "amount", "outline", "block_total")],
        )
    )
    parts = [payments, purpose_blank(overview), budget_not_positive(budget)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def quality_counts(report: DataFrame) -> DataFrame:
    return value_counts(report, "rule", "issues")
