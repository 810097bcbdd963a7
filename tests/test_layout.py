"""Stored tables: joins and groups without a shuffle, lookups that skip files, and hot projects."""

import glob
import zipfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from spendlens.operators import balance, lookup, reconcile
from spendlens.plans.fixtures import load
from spendlens.sources import archives, catalog, layout
from tests.conftest import SF_DIR
from tests.helpers import tuples

SHEETS = {"2-1": "budget", "5-1": "spend", "1-2": "org"}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder, target = tmp_path_factory.mktemp("sheets"), str(tmp_path_factory.mktemp("tables"))
    frames = dict(zip(SHEETS.values(), load(spark, SF_DIR.replace("sf0.01", "sf0.001"), *[f"fx_{n}" for n in SHEETS.values()])))
    for number, name in SHEETS.items():
        sheet = catalog.domain_names(frames[name], name).toPandas()
        with zipfile.ZipFile(folder / f"{number}_XX_2024_{catalog.SHEETS[name][0]}.zip", "w") as archive:
            archive.writestr("sheet.csv", sheet.to_csv(index=False))
    archives.ingest(spark, str(folder), target)
    catalog.register_views(spark, target)
    frames |= dict(zip(("spend_summary", "spend_detail"), load(spark, SF_DIR.replace("sf0.01", "sf0.001"), "fx_spend_summary", "fx_spend_detail")))
    return frames, {name: catalog.sheet(spark, name) for name in frames}


@pytest.fixture
def shuffled_joins(spark):
    """No broadcasts, as for large tables."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange " in line]


def close(rows):
    return sorted(str(tuple(round(v, 4) if isinstance(v, float) else v for v in r)) for r in rows)


def test_over_budget_without_a_shuffle(stored, shuffled_joins):
    frames, tables = stored
    result = balance.over_budget(tables["budget"], tables["spend"])
    assert all("rangepartitioning" in line for line in exchanges(result))  # only the sort of the result
    assert close(tuples(result)) == close(tuples(balance.over_budget(frames["budget"], frames["spend"])))


def test_execution_rates_without_a_shuffle(stored, shuffled_joins):
    frames, tables = stored
    result = balance.execution_rates(tables["budget"], tables["org"])
    assert all("_chunk" in line for line in exchanges(result))  # only the dealing of copies
    assert close(tuples(result)) == close(tuples(balance.execution_rates(frames["budget"], frames["org"])))


def test_reconcile_groups_without_a_shuffle(stored, shuffled_joins):
    frames, tables = stored
    names = ("spend_summary", "spend_detail", "org")
    assert close(tuples(reconcile.reconcile_summary_detail(*[tables[n] for n in names]))) == close(
        tuples(reconcile.reconcile_summary_detail(*[frames[n] for n in names]))
    )
    sums = tables["spend_detail"].groupBy("project_id", "block_no").agg(F.sum("amount"))
    assert exchanges(sums) == []


def test_lookup_reads_one_bucket(spark, tmp_path):
    rows = spark.range(4000).select((F.col("id") % 400).alias("予算事業ID"), F.col("id").alias("x"))
    placed = layout.layout_of(rows, "予算事業ID", 8)
    path = str(tmp_path / "t")
    layout.write(rows, path, placed)
    table = layout.read(spark, path, placed.facts())
    files = set(glob.glob(f"{path}/*.parquet"))
    of_id = {f for f in files if 10 in pq.read_table(f).column(0).to_pylist()}
    for file in files - of_id:
        with open(file, "wb") as broken:
            broken.write(b"not read")
    assert len(of_id) == 1 and len(files) == 8
    assert table.where("`予算事業ID` = 10").count() == 10


def row_groups(path, column, value):
    """Row groups in all, and those whose statistics and Bloom filter may not rule the value out."""
    every, some = 0, 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            every += 1
            some += stats is None or not stats.has_min_max or stats.min <= value <= stats.max
    return every, some


def test_a_hot_project_is_cut_by_ranges(spark, tmp_path):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900).alias("予算事業ID"), F.col("id").alias("x"))
    placed = layout.layout_of(rows, "予算事業ID", 16)
    assert not placed.bucketed
    path = str(tmp_path / "hot")
    layout.write(rows, path, placed)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/*.parquet")]
    assert len(sizes) == 16 and max(sizes) < 3 * sum(sizes) / 16  # though a third is one project
    every, some = row_groups(path, "予算事業ID", 500)
    assert every >= 16 and some <= 2
    back = layout.read(spark, path, placed.facts())
    assert back.count() == 30_000 and back.where("`予算事業ID` = 7").count() == rows.where("`予算事業ID` = 7").count()


def test_even_projects_are_bucketed(spark, tmp_path):
    rows = spark.range(5000).select((F.col("id") % 500).alias("予算事業ID"), F.lit("x").alias("計（a）"))
    placed = layout.layout_of(rows, "予算事業ID", 8)
    path = str(tmp_path / "even")
    layout.write(rows, path, placed)
    assert placed.bucketed and len(glob.glob(f"{path}/*.parquet")) == 8
    back = layout.read(spark, path, placed.facts())
    assert exchanges(back.groupBy("予算事業ID").count()) == [] and back.groupBy("予算事業ID").count().count() == 500
    assert exchanges(layout.read(spark, path, placed.facts()).groupBy("予算事業ID").count()) == []


def test_tables_without_projects_and_empty_ones(spark, tmp_path):
    plain = spark.range(3)
    placed = layout.layout_of(plain, "予算事業ID", 8)
    layout.write(plain, str(tmp_path / "plain"), placed)
    assert placed.column is None and layout.read(spark, str(tmp_path / "plain"), placed.facts()).count() == 3
    none = spark.createDataFrame([], "`予算事業ID` long")
    placed = layout.layout_of(none, "予算事業ID", 8)
    layout.write(none, str(tmp_path / "none"), placed)
    assert layout.read(spark, str(tmp_path / "none"), placed.facts()).count() == 0
    assert [layout.buckets_for(n) for n in (0, 8 << 27, 9 << 27, 10**17)] == [8, 8, 16, 65_536]
