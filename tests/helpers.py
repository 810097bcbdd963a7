"""Small frames for tests."""

from spendlens.functions import fixed_values as fv

BUDGET = (
    "project_id long, project_name string, fiscal_year int, account_class string, initial_amt double, "
    "supplementary_amt double, carryover_amt double, reserve_amt double, total_amt double, executed_amt double, "
    "execution_rate double"
)
SPEND = (
    "project_id long, project_name string, ministry string, block_no string, block_total double, payee string, "
    "corp_no long, outline string, amount double, method string, role string, payee_total double, bid_rate double"
)
ORG = "project_id long, project_name string, ministry string, other_no int"
OVERVIEW = "project_id long, project_name string, ministry string, purpose string, outline string"


def budget(spark, rows):
    """Rows of (project, name, total) or (project, name, total, initial, rate, executed)."""
    full = []
    for row in rows:
        project, name, total, initial, rate, executed = (*row, *[None] * (6 - len(row)))
        full.append((project, name, 2024, "A", initial, None, None, None, total, executed, rate))
    return spark.createDataFrame(full, BUDGET)


def spend(spark, rows):
    """Rows of dicts with some of the payment columns."""
    names = [part.split()[0] for part in SPEND.split(", ")]
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], SPEND)


def org(spark, rows):
    return spark.createDataFrame([(p, n, m, no) for p, n, m, no in rows], ORG)


def overview(spark, rows):
    return spark.createDataFrame(rows, OVERVIEW)


def tuples(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


__all__ = ["BUDGET", "ORG", "OVERVIEW", "SPEND", "budget", "fv", "org", "overview", "spend", "tuples"]
