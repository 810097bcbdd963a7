"""Project dossiers: all rows of all views for each project, nested, and back.

A dossier row is one page of one view of a project, for small projects as for
large ones. Pages hold up to a given number of records and are full but for the
last, so no row grows with its project; together they hold every record as often
as it occurs.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import StructType

from spendlens.functions import fixed_values as fv
from spendlens.operators.skew import COPIES, collapse, numbered, spread_join

PAGE_RECORDS = 1000
HOT_RECORDS = 200_000  # of a view of one project are numbered in one task, at most
NUMBER_DIGITS = 2  # a view of a project is numbered in up to 16**2 parts
KEEP_NULLS = {"ignoreNullFields": "false"}


def _keyed(views: Mapping[str, DataFrame], project_id: int | None, id_column: str) -> dict[str, DataFrame]:
    """The rows of each view that belong to projects, with the project as a long in ``_project``."""
    parts = {}
    for name in sorted(views):
        view = views[name]
        if id_column not in view.columns:
            continue
        key = F.col(f"`{id_column}`")
        rows = view.where(key.isNotNull() if project_id is None else key == F.lit(project_id))
        parts[name] = rows.withColumn("_project", key.cast("long"))
    if not parts:
        raise ValueError(f"no view has the column {id_column}")
    return parts


def _records(name: str, rows: DataFrame) -> DataFrame:
    columns = [F.col(f"`{c}`") for c in rows.columns if c != "_project"]
    record = F.to_json(F.struct(*columns), KEEP_NULLS)
    return rows.select(F.col("_project").alias("project_id"), F.lit(name).alias("view_name"), record.alias("record"))


def _folded(views: Mapping[str, DataFrame]) -> DataFrame:
    return collapse(reduce(DataFrame.unionByName, [_records(*v) for v in views.items()]), ["project_id", "view_name", "record"])


def project_records(
    views: Mapping[str, DataFrame], project_id: int | None = None, id_column: str = "project_id"
) -> DataFrame:
    """(project_id, view_name, record, copies): one row per distinct record of a view, with all its columns.

    Views without the id column are left out.
    """
    return _folded(_keyed(views, project_id, id_column))


def project_dossier(
    views: Mapping[str, DataFrame],
    org: DataFrame,
    page_records: int = PAGE_RECORDS,
    project_id: int | None = None,
    id_column: str = "project_id",
    parts: int | None = None,
) -> DataFrame:
    """(project_id, project_name, ministry, view_name, page, records), pages counted from 0 without gaps.

    Every record has a number within its view and project, fixed by its md5; the
    number divided by ``page_records`` is its page. Copies follow each other.

    The columns of a view are shuffled once by project, in ``parts`` parts, and
    written out and numbered where they then are; a view that is stored in as
    many buckets of the project is not shuffled. Projects with more than
    HOT_RECORDS records in a view are dealt by record instead.
    """
    if page_records < 2:
        raise ValueError("a page holds two records or more")
    rows = _keyed(views, project_id, id_column)
    parts = parts or int(org.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = _hot_projects(rows)
    lead = first_org(org.repartition(parts, "project_id")).hint("shuffle_hash")
    pages = []
    for name, view in rows.items():
        here = _records(name, view.where(~F.col("_project").isin(hot)).repartition(parts, "_project"))
        pages.append(_titled(_pages_in_place(here, page_records).join(lead, "project_id", "left")))
    if hot:
        large = _folded({name: view.where(F.col("_project").isin(hot)) for name, view in rows.items()})
        pages.append(_titled(spread_join(_dealt_pages(large, page_records), first_org(org), ["project_id"], "left")))
    return reduce(DataFrame.unionByName, pages)


def _hot_projects(rows: Mapping[str, DataFrame]) -> list[int]:
    """Projects with many records in a view: at most one for every HOT_RECORDS rows, counted before the plan is made."""
    counts = [view.groupBy("_project").agg(F.count(F.lit(1)).alias("_n")) for view in rows.values()]
    large = reduce(DataFrame.unionByName, counts).where(F.col("_n") > HOT_RECORDS)
    return [row["_project"] for row in large.select("_project").distinct().collect()]


def _titled(pages: DataFrame) -> DataFrame:
    name = F.coalesce("project_name", F.lit(fv.UNKNOWN_PROJECT)).alias("project_name")
    return pages.select("project_id", name, "ministry", "view_name", "page", "records")


def _pages_in_place(records: DataFrame, page_records: int) -> DataFrame:
    """Pages of one view's records, all of a project in one part."""
    nth = F.row_number().over(W.partitionBy("project_id").orderBy("_md5", "record")) - 1
    placed = records.withColumn("_md5", F.md5("record")).withColumn("_no", nth)
    page = F.floor(F.col("_no") / F.lit(page_records).cast("long")).alias("page")
    listed = F.array_sort(F.collect_list(F.struct("_no", "record")))
    pages = placed.groupBy("project_id", "view_name", page).agg(listed.alias("_records"))
    return pages.select("project_id", "view_name", "page", F.col("_records.record").alias("records"))


def _dealt_pages(records: DataFrame, page_records: int) -> DataFrame:
    """Pages of folded records, which are numbered in buckets; copies are unfolded inside their pages."""
    placed = numbered(
        records, ["project_id", "view_name"], ["record"], "_first", weight=COPIES, digits=NUMBER_DIGITS
    )
    size = F.lit(page_records).cast("long")
    last = F.col("_first") + F.col(COPIES) - 1
    cut = placed.withColumn("page", F.explode(F.sequence(F.floor(F.col("_first") / size), F.floor(last / size))))
    start = F.greatest(F.col("_first"), F.col("page") * size)
    end = F.least(last, (F.col("page") + 1) * size - 1)
    one = F.struct(start.alias("number"), "record", (end - start + 1).cast("int").alias("times"))
    pages = cut.groupBy("project_id", "view_name", "page").agg(F.array_sort(F.collect_list(one)).alias("_records"))
    unfolded = F.flatten(F.transform("_records", lambda r: F.array_repeat(r["record"], r["times"])))
    return pages.select("project_id", "view_name", "page", unfolded.alias("records"))


def first_org(org: DataFrame) -> DataFrame:
    """Name and ministry of the first organisation row of each project."""
    order = [c for c in ("other_no",) if c in org.columns]
    first = F.min(F.struct(*order, "project_name", "ministry")).alias("_first")
    return (
        org.groupBy(F.col("project_id").cast("long").alias("project_id"))
        .agg(first)
        .select("project_id", "_first.project_name", "_first.ministry")
    )


def dossier_json(dossier: DataFrame) -> DataFrame:
    """One JSON object per page: the only record of a view is an object, several are a list."""
    first = F.concat(
        _json_text("予算事業ID"), F.lit(":"), F.col("project_id").cast("string"), F.lit(","),
        _json_text("事業名"), F.lit(":"), _quoted(F.col("project_name")),
    )
    single = (F.size("records") == 1) & (F.col("page") == 0)
    several = F.concat(F.lit("["), F.array_join("records", ","), F.lit("]"))
    value = F.when(single, F.get("records", F.lit(0))).otherwise(several)
    body = F.concat(F.lit("{"), first, F.lit(","), _quoted(F.col("view_name")), F.lit(":"), value, F.lit("}"))
    return dossier.select("project_id", "view_name", "page", body.alias("dossier"))


def _json_text(text: str) -> Column:
    return F.lit('"' + text + '"')


def _quoted(column: Column) -> Column:
    """A string as a JSON string, quotes and control characters escaped."""
    return F.regexp_replace(F.to_json(F.array(column)), r"^\[|\]$", "")


def dossier_counts(dossier: DataFrame) -> DataFrame:
    """Records per project and view, counted inside the nested dossiers."""
    return dossier.groupBy("project_id", "project_name", "view_name").agg(
        F.sum(F.size("records")).cast("long").alias("records")
    )


def dossier_flatten(dossier: DataFrame, view_name: str, schema: StructType) -> DataFrame:
    """One row per record of a view of stored dossiers, with the ministry of the first organisation row."""
    records = dossier.where(F.col("view_name") == view_name).select(
        F.col("ministry").alias("lead_ministry"), F.explode("records").alias("record")
    )
    return records.select(F.from_json("record", schema).alias("r"), "lead_ministry").select("r.*", "lead_ministry")


def with_lead_ministry(view: DataFrame, org: DataFrame) -> DataFrame:
    """The rows of a view as ``dossier_flatten`` gives them, straight from the view."""
    lead = first_org(org).select("project_id", F.col("ministry").alias("lead_ministry"))
    return spread_join(view, lead, ["project_id"], "left")
