"""What project dossiers shuffle: the columns of a view once by project, stored payments not at all, and no records."""

import pytest
from pyspark.sql import functions as F

from spendlens.operators import dossier
from spendlens.plans import registry
from spendlens.plans.fixtures import load
from spendlens.sources import layout
from tests.conftest import SF_DIR
from tests.helpers import org, tuples


def world(spark):
    """Project 1 has many records, copies among them; ids are longs in one view, ints in the other; some are NULL."""
    rows = [(1, float(i % 70)) for i in range(300)] + [(2, 1.0)] * 3 + [(None, 5.0)] + [(i, 0.5) for i in range(3, 40)]
    notes = [(1, f"note {i % 5}") for i in range(12)] + [(2, None), (50, 'say "hi"')]
    views = {
        "amounts": spark.createDataFrame(rows, "project_id long, amount double").repartition(3),
        "notes": spark.createDataFrame(notes, "project_id int, note string"),
    }
    return views, org(spark, [(i, f"project {i}", "M", no) for i in range(1, 30) for no in range(2)])


@pytest.mark.parametrize("hot", [0, 40, 1000])
@pytest.mark.parametrize("parts", [None, 3])
def test_pages_in_place_and_dealt_are_the_same(spark, monkeypatch, hot, parts):
    views, orgs = world(spark)
    records = dossier.project_records(views)
    pages = dossier._dealt_pages(records, 25)  # as folded and numbered in buckets
    names = {i: (f"project {i}", "M") for i in range(1, 30)}
    want = {(p, *names.get(p, (dossier.fv.UNKNOWN_PROJECT, None)), v, n, tuple(r)) for p, v, n, r in tuples(pages, "project_id", "view_name", "page", "records")}
    monkeypatch.setattr(dossier, "HOT_RECORDS", hot)
    got = dossier.project_dossier(views, orgs, page_records=25, parts=parts)
    rows = [(*r[:5], tuple(r[5])) for r in tuples(got)]
    assert len(rows) == len(want) and set(rows) == want
    assert max(n for *_, n, _ in rows) == 11


def carried(node):
    """The columns of every shuffle of a plan that ran."""
    name = node.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        yield from carried(node.executedPlan())
    elif name.endswith("QueryStage"):
        yield from carried(node.plan())
    elif not name.startswith("Reused"):
        if name == "Exchange":
            yield node.output().mkString(",")
        children = node.children()
        for i in range(children.size()):
            yield from carried(children.apply(i))


def test_no_record_and_no_payment_is_shuffled(spark):
    df = registry.queries()["project_dossier"](spark, SF_DIR)
    assert df.collect()
    shuffles = list(carried(df._jdf.queryExecution().executedPlan()))
    assert len(shuffles) > 3 and not any("record" in line or "bid_rate#" in line or "_md5" in line for line in shuffles)


def test_payments_are_stored_by_project_unless_one_is_too_large(spark, tmp_path):
    [spend] = load(spark, SF_DIR, "fx_spend", payments=["*"], buckets=8)
    counted = spend.groupBy("project_id").count()
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    [plain] = load(spark, SF_DIR, "fx_spend")
    assert spend.exceptAll(plain).isEmpty() and plain.exceptAll(spend).isEmpty()
    rows = spark.range(1000).select(F.when(F.col("id") < 800, 1).otherwise(F.col("id")).alias("project_id"), "id")
    assert layout.stored_by(rows, "project_id", 8, str(tmp_path / "t")) is rows
