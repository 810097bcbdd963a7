"""Archives, catalog, type inference, SQL reports and sinks."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from spendlens.functions import fixed_values as fv
from spendlens.operators import balance
from spendlens.plans.sql_report import run_sql, run_sql_file
from spendlens.sources import archives, catalog, inference, published, sinks
from tests.helpers import tuples

SPEND_CSV = """予算事業ID,事業名,府省庁,支出先ブロック番号,ブロックの合計支出額,支出先名,法人番号,契約概要,金額
1,道路,国交省,A,100,,,,
1,道路,国交省,A,,会社,1234567890123,"工事
第一",90
2,学校,文科省,A,,社団,,給食,"1,000"
2,学校,文科省,A,,社団,,給食,5
"""
BUDGET_CSV = """予算事業ID,事業名,予算年度,計（歳出予算現額合計）,開始年度不明,翌年度への繰越し(合計),内容/ 目標
1,道路,2024,50,True,,a
2,学校,2024,700.5,False,1,b
"""


def put(folder, name, text, encoding="utf-8"):
    with zipfile.ZipFile(folder / name, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("sheet.csv", text.encode(encoding))


@pytest.fixture(scope="module")
def ingested(spark, tmp_path_factory):
    folder, target = tmp_path_factory.mktemp("zips"), str(tmp_path_factory.mktemp("tables"))
    put(folder, f"5-1_XX_2024_{fv.SPEND_VIEW}.zip", SPEND_CSV)
    put(folder, f"2-1_XX_2024_{fv.BUDGET_VIEW}.zip", BUDGET_CSV, "shift_jis")
    put(folder, "1-1_XX_2024_same_name.zip", "予算事業ID,x\n1,a\n", "utf-8-sig")
    put(folder, "1-2_XX_2024_same_name.zip", "予算事業ID,x\n1,\n2,3\n")
    put(folder, "1-2_YY_2024_taken.zip", "a\n1\n")
    put(folder, "9-1_XX_2024_ragged.zip", "a,b\n1,2\n1,2,3\n")
    put(folder, "9-3_XX_2024_header+only 100%.zip", "a,b\n")
    (folder / "9-2_XX_2024_broken.zip").write_bytes(b"this is not an archive")
    bad = io.BytesIO()
    with zipfile.ZipFile(bad, "w") as archive:
        archive.writestr("x.csv", b"a,b\n\xff\xfe\xfd,\x80\x81\n")
    (folder / "9-4_XX_2024_bytes.zip").write_bytes(bad.getvalue())
    index = archives.ingest(spark, str(folder), target)
    return index, target


def test_catalog_of_archives(ingested):
    index, _ = ingested
    names = {t: v for t, v in tuples(index, "table_name", "view_name")}
    assert names["tbl_5_1"] == fv.SPEND_VIEW
    assert names["tbl_5_1_summary"] == fv.SPEND_SUMMARY_VIEW
    assert names["tbl_5_1_details"] == fv.SPEND_DETAIL_VIEW
    assert sorted((names["tbl_1_1"], names["tbl_1_2"])) == ["same_name", "same_name_2"]
    assert names["tbl_9_3"] == "header+only 100%"
    assert not {"tbl_9_1", "tbl_9_2", "tbl_9_4"} & set(names)


def test_archives_left_out_are_listed(spark, ingested):
    _, target = ingested
    errors = {p.split("/")[-1][:6]: e for p, e in tuples(spark.read.parquet(f"{published.current(spark, target)}/ingest_errors"), "path", "error")}
    assert set(errors) == {"9-1_XX", "9-2_XX", "9-4_XX", "1-2_YY"}
    assert "BadZipFile" in errors["9-2_XX"] and "shift_jis" in errors["9-4_XX"] and "same table" in errors["1-2_YY"]


def test_types_and_cells(spark, ingested):
    target = published.current(spark, ingested[1])
    spend = spark.read.parquet(f"{target}/tbl_5_1")
    kinds = dict(spend.dtypes)
    assert (kinds["予算事業ID"], kinds["法人番号"], kinds["金額"], kinds["契約概要"]) == ("bigint", "double", "string", "string")
    assert spend.where(F.col("契約概要") == "工事\n第一").count() == 1
    budget = dict(spark.read.parquet(f"{target}/tbl_2_1").dtypes)
    assert (budget["開始年度不明"], budget["計（歳出予算現額合計）"]) == ("boolean", "double")
    assert spark.read.parquet(f"{target}/tbl_1_1").columns == ["予算事業ID", "x"]  # the BOM is gone
    assert dict(spark.read.parquet(f"{target}/tbl_1_2").dtypes)["x"] == "double"
    assert spark.read.parquet(f"{target}/tbl_9_3").count() == 0


def test_split_tables_hold_every_row_once(spark, ingested):
    target = published.current(spark, ingested[1])
    summary, detail = (spark.read.parquet(f"{target}/tbl_5_1_{p}") for p in ("summary", "details"))
    assert sorted(tuples(detail, "金額")) == [(5.0,), (90.0,)]
    assert summary.count() == 2 and summary.where(F.col("金額").isNotNull()).count() == 0


def test_operators_on_the_domain_views(spark, ingested):
    _, target = ingested
    names = catalog.register_views(spark, target)
    assert fv.SPEND_DETAIL_VIEW in names
    detail = catalog.sheet(spark, "spend_detail")
    over = balance._over_budget(balance.budget_by_project(catalog.sheet(spark, "budget")), detail)
    assert tuples(over, "project_id", "excess") == [(1, 40.0)]
    assert "支出先名" in catalog.domain_names(detail, "spend_detail").columns
    text = f'SELECT "予算事業ID", SUM("金額") AS "合計" FROM "{fv.SPEND_DETAIL_VIEW}" WHERE "予算事業ID" = :id GROUP BY 1;'
    assert tuples(run_sql(spark, text, {"id": 1})) == [(1, 90.0)]
    assert spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers") == "false"
    # names without quotes, text in other scripts in strings and comments, a comment after the end
    text = f"""
    -- 事業ごとの予算と支出
    WITH 予算額 AS (SELECT 予算事業ID, 事業名, SUM("計（歳出予算現額合計）") AS 合計 FROM "{fv.BUDGET_VIEW}" GROUP BY 予算事業ID, 事業名)
    SELECT b.事業名, b.合計 AS 予算, e."金額" AS 支出 FROM 予算額 AS b JOIN {fv.SPEND_DETAIL_VIEW} AS e
    ON b.予算事業ID = e.予算事業ID /* 結合 */ WHERE b.事業名 LIKE '%道路%' ORDER BY 支出 DESC; -- 終わり"""
    result = run_sql(spark, text)
    assert result.columns == ["事業名", "予算", "支出"] and tuples(result) == [("道路", 50.0, 90.0)]


def test_verify_reports_missing_tables(spark, ingested):
    index, target = ingested
    more = index.select("table_name", "view_name").union(spark.createDataFrame([("tbl_gone", "gone")], "t string, v string"))
    status = {v: (n, s) for v, n, s in tuples(catalog.verify(spark, more, target))}
    assert status["gone"] == (None, "MISSING") and status[fv.SPEND_VIEW] == (4, "OK")


def test_schema_document_there_and_back(spark, tmp_path):
    df = spark.createDataFrame([], "a string, b long, c double, d boolean, e int")
    rows = catalog.schema_rows(spark, {"tbl_1": ("view", "file.zip", df)})
    assert tuples(rows, "column_name", "column_type") == [
        ("a", "VARCHAR"), ("b", "BIGINT"), ("c", "DOUBLE"), ("d", "BOOLEAN"), ("e", "INTEGER"),
    ]
    sinks.write_json_lines(catalog.schema_document(rows), str(tmp_path / "schema"))
    back = catalog.schema_csv_rows(spark.read.json(str(tmp_path / "schema")))
    assert tuple(back.columns) == fv.SCHEMA_CSV_HEADER
    assert tuples(back) == tuples(rows.drop("position"))


def test_schema_document_keeps_the_order_of_columns(spark):
    wide = spark.createDataFrame([], ", ".join(f"c{i} string" for i in range(40)))
    rows = catalog.schema_rows(spark, {"tbl_1": ("view", "file.zip", wide)}).repartition(7, "column_name")
    [nested] = catalog.schema_document(rows).collect()
    assert [c["name"] for c in nested["columns"]] == [f"c{i}" for i in range(40)]


def test_view_names_stay_unique(spark):
    files = ["1_x_y_a.zip", "2_x_y_a.zip", "3_x_y_a_2.zip", "4_x_y.zip", "5_x.zip"]
    df = spark.createDataFrame([(f,) for f in files], "file_name string")
    rows = tuples(catalog.archive_names(df), "file_name", "table_name", "view_name")
    assert len({v for *_, v in rows}) == len(files)
    assert {t for _, t, _ in rows} == {f"tbl_{i}" for i in range(1, 6)}


def test_view_names_stay_unique_over_the_whole_catalog(spark):
    files = [f"{i}_x_y_{name}.zip" for i, name in enumerate(["a", "a", "a_2", "a_2", "a", "b", f"b{fv.SUMMARY_VIEW_SUFFIX}"])]
    df = spark.createDataFrame([(f,) for f in files], "file_name string")
    rows = tuples(catalog.table_catalog(df, "5_x_y_b.zip"), "file_name", "view_name", "part")
    names = [v for _, v, _ in rows]
    assert len(rows) == 9 and len(set(names)) == 9
    assert {"a", "a_2", "a_2_2", "a_3", "a_4", "b", f"b{fv.SUMMARY_VIEW_SUFFIX}", f"b{fv.SUMMARY_VIEW_SUFFIX}_2"} <= set(names)
    assert next(v for f, v, _ in rows if f == files[6]) == f"b{fv.SUMMARY_VIEW_SUFFIX}"


def test_inference(spark):
    rows = [("1", "1", "True", None, "x", "1.5"), ("2", None, "false", None, "1", "-2e3")]
    df = spark.createDataFrame(rows, "i string, gap string, flag string, none string, text string, num string")
    kinds = {n: k for n, k in tuples(inference.inferred_types(df), "column_name", "column_type")}
    assert kinds == {"i": "BIGINT", "gap": "DOUBLE", "flag": "BOOLEAN", "none": "DOUBLE", "text": "VARCHAR", "num": "DOUBLE"}


def test_csv_has_one_mark_per_file(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "quoted", 道路'), (2, None)], "id long, text string").coalesce(1)
    sinks.write_csv(df, str(tmp_path / "with"))
    sinks.write_csv(df, str(tmp_path / "without"), bom=False)
    with_mark = next((tmp_path / "with").glob("*.csv")).read_bytes()
    assert with_mark.startswith(b"\xef\xbb\xbfid,text") and with_mark.count(b"\xef\xbb\xbf") == 1
    assert next((tmp_path / "without").glob("*.csv")).read_bytes() == with_mark[3:]
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "with"))
    assert sorted(tuples(back)) == [("1", 'a "quoted", 道路'), ("2", None)]


def test_json_and_parquet(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "道路")], "id long, text string")
    sinks.write_json_lines(df, str(tmp_path / "json"))
    lines = [json.loads(t) for f in (tmp_path / "json").glob("*.json") for t in f.read_text("utf-8").splitlines()]
    assert {"id": 1, "text": None} in lines and "道路" in (l["text"] for l in lines)
    (tmp_path / "nested.json").write_text('{"a": {"b": [1,\n2]}}', encoding="utf-8")
    assert tuples(sinks.read_json(spark, str(tmp_path / "nested.json")), "a.b") == [([1, 2],)]
    sinks.write_parquet(spark.range(10).coalesce(1), str(tmp_path / "parquet"), rows_per_file=4)
    assert len(list((tmp_path / "parquet").glob("*.parquet"))) == 3
    texts = spark.createDataFrame([('{"a":1}',)], "t string")
    sinks.write_json_text(texts, "t", str(tmp_path / "text"))
    assert spark.read.text(str(tmp_path / "text")).first()[0] == '{"a":1}'


def test_sql_file_to_csv(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("`三`")
    (tmp_path / "q.sql").write_text('-- 数\nSELECT COUNT(*) AS "数" FROM "三";', encoding="utf-8")
    result = run_sql_file(spark, str(tmp_path / "q.sql"), str(tmp_path / "out"))
    assert tuples(result) == [(3,)]
    text = next((tmp_path / "out").glob("*.csv")).read_text("utf-8-sig")
    assert text.splitlines() == ["数", "3"]


def test_sql_leaves_no_views_behind(spark):
    spark.range(5).createOrReplaceTempView("kept_view")
    views = {"kept_view": spark.range(3), "名前 x": spark.range(7)}
    result = run_sql(spark, 'SELECT (SELECT COUNT(*) FROM "kept_view") AS a, COUNT(*) AS b FROM "名前 x"', views=views)
    assert not spark.catalog.tableExists("`名前 x`") and spark.table("kept_view").count() == 5
    assert tuples(result) == [(3, 7)]
    spark.catalog.dropTempView("kept_view")
