"""Sheets in, results out: the views as zipped CSV sheets give the results of the views themselves."""

import json
import zipfile
from collections import Counter

import pytest

from spendlens.functions import fixed_values as fv
from spendlens.operators import balance, documents, dossier, flows, lookup, quality, reconcile
from spendlens.plans.fixtures import load
from spendlens.sources import archives, catalog, published
from tests.helpers import tuples

SF_DIR = "/root/testdata/sf0.001"
PROJECT_ID = next(full for full, short in fv.PROJECT_COLUMNS.items() if short == "project_id")
SHEETS = {
    "2-1": "budget", "5-1": "spend", "1-1": "org", "1-2": "overview", "5-4": "obligation", "5-3": "breakdown",
    "1-5": "related", "6-1": "remarks",
}


@pytest.fixture(scope="module")
def worlds(spark, tmp_path_factory):
    """(frames of the views, frames of the ingested sheets) by name."""
    folder, target = tmp_path_factory.mktemp("sheets"), str(tmp_path_factory.mktemp("tables"))
    direct = dict(zip(SHEETS.values(), load(spark, SF_DIR, *[f"fx_{n}" for n in SHEETS.values()])))
    for number, name in SHEETS.items():
        view, _ = catalog.SHEETS[name]
        sheet = catalog.domain_names(direct[name], name).toPandas()
        with zipfile.ZipFile(folder / f"{number}_XX_2024_{view}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("sheet.csv", sheet.to_csv(index=False))
    archives.ingest(spark, str(folder), target)
    assert spark.read.parquet(f"{published.current(spark, target)}/ingest_errors").count() == 0
    catalog.register_views(spark, target)
    names = [*SHEETS.values(), "spend_summary", "spend_detail"]
    ingested = {name: catalog.sheet(spark, name) for name in names}
    direct |= dict(zip(names[-2:], load(spark, SF_DIR, "fx_spend_summary", "fx_spend_detail")))
    return direct, ingested


ANALYSES = {
    "over_budget": (balance.over_budget, "budget", "spend"),
    "over_budget_cause": (balance.over_budget_cause, "budget", "spend", "obligation"),
    "execution_rates": (balance.execution_rates, "budget", "org"),
    "rate_gap": (balance.rate_gap_top, "budget", "spend"),
    "grouped": (balance.spend_vs_budget_grouped, "budget", "spend"),
    "blocks": (reconcile.reconcile_summary_detail, "spend_summary", "spend_detail", "org"),
    "contracts": (reconcile.reconcile_detail_breakdown, "spend_detail", "breakdown", "org"),
    "quality": (quality.quality_report, "spend", "overview", "budget"),
    "ministries": (lookup.ministry_summary, "org", "overview", "budget"),
    "edges": (flows.fund_flow_edges, "spend_detail"),
    "sample": (lookup.text_sample, "spend_detail", "org"),
    "related": (lookup.related_projects, "related", "budget"),
    "remarks": (lookup.rows_of_projects, "remarks", "obligation"),
}


@pytest.mark.parametrize("name", list(ANALYSES))
def test_sheets_give_the_results_of_the_views(worlds, name):
    analysis, *inputs = ANALYSES[name]
    want, got = (analysis(*[frames[i] for i in inputs]) for frames in worlds)
    columns = sorted(set(want.columns) & set(got.columns))
    assert set(got.columns) <= set(want.columns) and len(columns) > 1
    rows = Counter(tuples(want, *columns))
    assert Counter(tuples(got, *columns)) == rows
    assert rows or name == "related"


def test_documents_of_sheets(worlds):
    counts = [documents.rag_documents(f["spend_detail"], f["org"], f["overview"]).count() for f in worlds]
    assert counts[0] == counts[1] > 0


def test_split_is_complete(worlds):
    _, sheets = worlds
    assert sheets["spend_summary"].count() + sheets["spend_detail"].count() == sheets["spend"].count()


def test_dossier_of_ingested_sheets_has_every_column(spark, worlds):
    _, sheets = worlds
    names = [row.name for row in spark.catalog.listTables() if row.isTemporary]
    views = {name: spark.table(f"`{name}`") for name in names if PROJECT_ID in spark.table(f"`{name}`").columns}
    assert len(views) >= 9
    project = sheets["spend"].where("project_id IS NOT NULL").select("project_id").first()[0]
    pages = dossier.project_dossier(views, sheets["org"], project_id=project, id_column=PROJECT_ID)
    seen = Counter()
    for view, text in tuples(dossier.dossier_json(pages), "view_name", "dossier"):
        page = json.loads(text)
        records = page[view] if isinstance(page[view], list) else [page[view]]
        assert page[PROJECT_ID] == project
        assert all(set(r) == set(views[view].columns) for r in records)
        seen[view] += len(records)
    assert seen == {
        name: n for name, view in views.items() if (n := view.where(f"`{PROJECT_ID}` = {project}").count())
    }
