"""Look up, rank, sample and list: projects, payments, ministries, relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.functions import fixed_values as fv
from spendlens.functions.columns import contains_any, first_asc, first_desc, identity_text, money_sum, percent
from spendlens.operators.balance import top_budget_project
from spendlens.operators.skew import COPIES, collapse, expand, expand_sorted, spread_join


def scan_limit(table: DataFrame, n: int = 100) -> DataFrame:
    """The first n rows in the order of all columns."""
    return table.orderBy(*first_asc(*table.columns)).limit(n)


def rows_of_project(table: DataFrame, project_id: int) -> DataFrame:
    return table.where(F.col("project_id") == F.lit(project_id))


def rows_of_projects(table: DataFrame, ids: DataFrame) -> DataFrame:
    """All rows whose project is among ``ids``, however many these are, with the table's own columns."""
    return spread_join(table, ids.select("project_id").distinct(), ["project_id"], "left_semi")


def _keyword_projects(
    overview: DataFrame, name_words: Sequence[str], purpose_words: Sequence[str]
) -> DataFrame:
    return overview.where(contains_any("project_name", name_words) | contains_any("purpose", purpose_words))


def keyword_projects(
    overview: DataFrame,
    org: DataFrame,
    budget: DataFrame,
    name_words: Sequence[str] = fv.NAME_KEYWORDS,
    purpose_words: Sequence[str] = fv.PURPOSE_KEYWORDS,
) -> DataFrame:
    """Positive budget rows of projects with a keyword in name or purpose."""
    found = collapse(
        _keyword_projects(overview, name_words, purpose_words), ["project_id", "project_name"], "_found"
    )
    ministries = collapse(org, ["project_id", "ministry"], "_org")
    projects = found.join(ministries, "project_id")
    # a keyword picks few projects: drop the other budget rows before the first shuffle
    lines = rows_of_projects(budget.where(F.col("total_amt") > 0), found)
    amounts = collapse(lines, ["project_id", "total_amt"], "_rows")
    joined = spread_join(amounts, projects, ["project_id"]).select(
        "project_id",
        "project_name",
        "ministry",
        F.col("total_amt").alias("budget_amt"),
        (F.col("_found") * F.col("_org") * F.col("_rows")).alias(COPIES),
    )
    return expand_sorted(joined, [*first_desc("budget_amt"), *first_asc("project_id", "ministry")])


def keyword_total(
    overview: DataFrame,
    budget: DataFrame,
    name_words: Sequence[str] = fv.NAME_KEYWORDS,
    purpose_words: Sequence[str] = fv.PURPOSE_KEYWORDS,
) -> DataFrame:
    """Number and sum of positive budget rows of keyword projects (rows, not projects)."""
    found = _keyword_projects(overview, name_words, purpose_words).groupBy("project_id").agg(
        F.count(F.lit(1)).alias("_found")
    )
    amounts = (
        budget.where(F.col("total_amt") > 0)
        .groupBy("project_id")
        .agg(F.count(F.lit(1)).alias("_rows"), money_sum("total_amt").alias("_sum"))
    )
    return found.join(amounts, "project_id").agg(
        F.coalesce(F.sum(F.col("_found") * F.col("_rows")), F.lit(0)).alias("budget_rows"),
        money_sum(F.col("_found") * F.col("_sum")).alias("budget_total"),
    )


def impact_ratio(totals: DataFrame, volume: float, rate_cut: float) -> DataFrame:
    """Assumed loss of revenue (volume x rate cut) as a share of the keyword budget."""
    loss = F.lit(float(volume) * float(rate_cut))
    return totals.select(
        "budget_rows",
        "budget_total",
        loss.alias("assumed_loss"),
        percent(loss, F.col("budget_total")).alias("impact_pct"),
    )


def ministry_summary(org: DataFrame, overview: DataFrame, budget: DataFrame) -> DataFrame:
    """Projects and positive budget sum per ministry.

    Counts every organisation row against every budget row, as the row-level
    join of the three tables does, but joins one row per project: a sum over
    the joined rows is the budget sum times the number of matching rows.
    """
    ministries = collapse(org, ["project_id", "ministry"], "_org")
    described = overview.groupBy("project_id").agg(F.count(F.lit(1)).alias("_described"))
    amounts = (
        budget.where(F.col("total_amt") > 0).groupBy("project_id").agg(money_sum("total_amt").alias("_sum"))
    )
    joined = ministries.join(described, "project_id", "left").join(amounts, "project_id")
    times = F.col("_org") * F.coalesce("_described", F.lit(1))
    return (
        joined.groupBy("ministry")
        .agg(
            F.count(F.when(F.col("_described").isNotNull(), F.col("project_id"))).alias("projects"),
            money_sum(F.col("_sum") * times).alias("budget_total"),
        )
        .orderBy(*first_desc("budget_total"), *first_asc("ministry"))
    )


def contracts_with_names(detail: DataFrame, org: DataFrame) -> DataFrame:
    """(project id, project name, payee, outline), no name missing, with the number of rows."""
    contracts = collapse(
        detail.where(F.col("outline").isNotNull() & F.col("payee").isNotNull()),
        ["project_id", "payee", "outline"],
        "_contracts",
    )
    names = collapse(org.where(F.col("project_name").isNotNull()), ["project_id", "project_name"], "_org")
    return spread_join(contracts, names, ["project_id"]).select(
        "project_id", "project_name", "payee", "outline", (F.col("_contracts") * F.col("_org")).alias(COPIES)
    )


def sample_key(df: DataFrame, columns: Sequence[str], number: str, seed: int) -> Column:
    """A row's key in a random sample, from its values and the number of the copy."""
    return F.md5(identity_text(df, columns, extra=[F.col(number), F.lit(seed)]))


def sample_rows(folded: DataFrame, n: int, seed: int) -> DataFrame:
    """n random rows of a folded table, the same for every partitioning.

    Every copy draws its own key, so copies are as likely as other rows.
    """
    columns = [c for c in folded.columns if c != COPIES]
    drawn = expand(folded, index="_no", spread=True)
    key = sample_key(drawn, columns, "_no", seed)
    return drawn.withColumn("_key", key).orderBy("_key", *first_asc(*columns)).limit(n).select(*columns)


def text_sample(detail: DataFrame, org: DataFrame, n: int = 100, seed: int = 0) -> DataFrame:
    return sample_rows(contracts_with_names(detail, org), n, seed).drop("project_id")


def related_projects(related: DataFrame, budget: DataFrame, project_id: int | None = None) -> DataFrame:
    """Related rows of the given project, or of the one with the largest budget."""
    if project_id is not None:
        return rows_of_project(related, project_id)
    return rows_of_projects(related, top_budget_project(budget))


def value_counts(df: DataFrame, column: str, count: str = "n") -> DataFrame:
    """Rows per value, missing values left out, most frequent first."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(count))
        .orderBy(*first_desc(count), *first_asc(column))
    )


def unique_values(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(column).distinct()


def top_payees(detail: DataFrame, ids: DataFrame, n: int = 3) -> DataFrame:
    """The n payees that got most within the given few projects."""
    return (
        rows_of_projects(detail, ids)
        .groupBy("payee")
        .agg(money_sum("amount").alias("spend_total"))
        .orderBy(*first_desc("spend_total"), *first_asc("payee"))
        .limit(n)
        .withColumn("spend_text", F.format_number(F.col("spend_total").cast("decimal(38,0)"), 0))
    )
