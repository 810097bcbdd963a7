"""The table catalog: names, row counts, samples, columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from spendlens.functions import fixed_values as fv
from spendlens.operators.skew import numbered
from spendlens.sources import layout, published
from spendlens.sources.inference import as_text, inferred_types, union_all

# --- fixed values: type names of the schema document --------------------------
TYPE_NAMES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def archive_names(archives: DataFrame) -> DataFrame:
    """Add ``table_name`` and ``view_name`` to archives with a ``file_name``.

    5-1_XX_2024_a_b.zip gives table tbl_5_1 and view a_b. Further archives with
    the same view name get _2, _3 ... as far as no archive is called so itself;
    the order among them is fixed by md5.
    """
    stem = F.regexp_replace(F.element_at(F.split("file_name", "/"), -1), r"\.zip$", "")
    parts = F.split(stem, "_")
    named = archives.withColumn(
        "table_name", F.concat(F.lit(fv.TABLE_PREFIX), F.translate(parts[0], "-", "_"))
    ).withColumn("view_name", F.array_join(F.slice(parts, 4, F.greatest(F.size(parts), F.lit(1))), "_"))
    return _unique_names(named, ["file_name"])


def _unique_names(rows: DataFrame, identity: Sequence[str], keeps: Column | None = None) -> DataFrame:
    """Make ``view_name`` unique: of equal names one stays, the others get the next free numbers.

    Rows for which ``keeps`` holds come first. A name with a number added can
    only meet names that end in that number, and those numbers are passed over,
    so one round is enough.
    """
    group = ["view_name", "_later"]
    flagged = rows.withColumn("_later", F.lit(0) if keeps is None else F.when(keeps, 0).otherwise(1))
    counted = numbered(flagged, group, identity, "_before")
    firsts = flagged.groupBy("view_name").agg(F.count_if(F.col("_later") == 0).alias("_firsts"))
    ending = r"^(.*)_([1-9][0-9]*)$"
    taken = (
        rows.where(F.col("view_name").rlike(ending))
        .select(
            F.regexp_extract("view_name", ending, 1).alias("view_name"),
            F.regexp_extract("view_name", ending, 2).try_cast("long").alias("_number"),
        )
        .groupBy("view_name")
        .agg(F.array_sort(F.collect_set("_number")).alias("_taken"))
    )
    joined = counted.join(firsts, "view_name").join(taken, "view_name", "left")
    place = F.col("_before") + 1 + F.when(F.col("_later") == 1, F.col("_firsts")).otherwise(0)
    number = F.aggregate(
        F.filter(F.coalesce("_taken", F.array().cast("array<long>")), lambda n: n >= 2),
        place.cast("long"),
        lambda free, n: F.when(n <= free, free + 1).otherwise(free),
    )
    name = F.when(place == 1, F.col("view_name")).otherwise(F.concat("view_name", F.lit("_"), number.cast("string")))
    return joined.select(*[name.alias(c) if c == "view_name" else F.col(c) for c in rows.columns])


def table_catalog(archives: DataFrame, split_archive: str = fv.SPLIT_ARCHIVE) -> DataFrame:
    """(table_name, view_name, file_name, part): one row per table.

    The archive whose name ends with ``split_archive`` also gives a summary and
    a detail table.
    """
    named = archive_names(archives)
    part = F.when(
        F.col("file_name").endswith(split_archive), F.array(F.lit("all"), F.lit("summary"), F.lit("detail"))
    ).otherwise(F.array(F.lit("all")))
    rows = named.withColumn("part", F.explode(part))

    def suffixed(column: str, summary: str, detail: str) -> Column:
        return F.concat(
            column,
            F.when(F.col("part") == "summary", summary).when(F.col("part") == "detail", detail).otherwise(""),
        )

    all_names = rows.select(
        suffixed("table_name", fv.SUMMARY_TABLE_SUFFIX, fv.DETAIL_TABLE_SUFFIX).alias("table_name"),
        suffixed("view_name", fv.SUMMARY_VIEW_SUFFIX, fv.DETAIL_VIEW_SUFFIX).alias("view_name"),
        "file_name",
        "part",
    )
    # a sheet may be called like a derived view: the sheet keeps its name
    return _unique_names(all_names, ["file_name", "part"], keeps=F.col("part") == "all")


def register_views(spark: SparkSession, target: str) -> list[str]:
    """Temp views under their human names over the tables of the current build; returns the names."""
    tables = published.manifest(spark, target).get("tables", {})
    target = published.current(spark, target)
    names = []
    catalog = spark.read.parquet(f"{target}/table_index").orderBy("view_name")
    for row in catalog.select("table_name", "view_name").toLocalIterator():
        if row["view_name"] in names:
            raise ValueError(f"two tables have the view name {row['view_name']}")
        quoted = "`" + row["view_name"].replace("`", "``") + "`"
        placed = tables.get(row["table_name"], {}).get("layout")
        layout.read(spark, f"{target}/{row['table_name']}", placed).createOrReplaceTempView(quoted)
        names.append(row["view_name"])
    return names


# the sheets an operator reads: view name and domain column -> operator column
SHEETS = {
    "budget": (fv.BUDGET_VIEW, fv.BUDGET_COLUMNS),
    "spend": (fv.SPEND_VIEW, fv.SPEND_COLUMNS),
    "spend_summary": (fv.SPEND_SUMMARY_VIEW, fv.SPEND_COLUMNS),
    "spend_detail": (fv.SPEND_DETAIL_VIEW, fv.SPEND_COLUMNS),
    "breakdown": (fv.BREAKDOWN_VIEW, fv.BREAKDOWN_COLUMNS),
    "block_edges": (fv.BLOCK_EDGES_VIEW, fv.BLOCK_EDGES_COLUMNS),
    "obligation": (fv.OBLIGATION_VIEW, fv.OBLIGATION_COLUMNS),
    "org": (fv.ORG_VIEW, fv.ORG_COLUMNS),
    "overview": (fv.OVERVIEW_VIEW, fv.OVERVIEW_COLUMNS),
    "related": (fv.RELATED_VIEW, fv.RELATED_COLUMNS),
    "remarks": (fv.REMARKS_VIEW, fv.REMARKS_COLUMNS),
}


def sheet(spark: SparkSession, name: str) -> DataFrame:
    """A registered domain view with the columns the operators use, under their names."""
    view, columns = SHEETS[name]
    table = spark.table(f"`{view}`")
    known = {**fv.PROJECT_COLUMNS, **columns}
    return table.select(*[F.col(f"`{c}`").alias(known[c]) for c in table.columns if c in known])


def domain_names(df: DataFrame, name: str) -> DataFrame:
    """Operator columns back to domain columns, other columns unchanged."""
    back = {short: full for full, short in {**fv.PROJECT_COLUMNS, **SHEETS[name][1]}.items()}
    return df.withColumnsRenamed({c: back[c] for c in df.columns if c in back})


def row_counts(views: Mapping[str, DataFrame]) -> DataFrame:
    """(view_name, row_count, status) of every view."""
    return union_all(
        [
            view.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("view_name"), "row_count", F.lit("OK").alias("status")
            )
            for name, view in sorted(views.items())
        ]
    )


def stored_counts(spark: SparkSession, target: str) -> DataFrame:
    """(table_name, column_name, row_count, null_count) of the current build, as counted when it was written."""
    counts = published.manifest(spark, target).get("tables", {})
    rows = [(table, c, n["rows"], nulls) for table, n in sorted(counts.items()) for c, nulls in n["nulls"].items()]
    return spark.createDataFrame(rows, "table_name string, column_name string, row_count bigint, null_count bigint")


def verify(spark: SparkSession, catalog: DataFrame, target: str) -> DataFrame:
    """Row counts of all cataloged tables of the current build; a table that cannot be read has status MISSING."""
    target = published.current(spark, target)
    schema = "view_name string, row_count bigint, status string"
    parts = []
    for row in catalog.orderBy("view_name").toLocalIterator():
        try:
            table = spark.read.parquet(f"{target.rstrip('/')}/{row['table_name']}")
            parts.append(row_counts({row["view_name"]: table}))
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
            parts.append(spark.createDataFrame([(row["view_name"], None, "MISSING")], schema))
    return union_all(parts)


def sample_of_views(views: Mapping[str, DataFrame], first_views: int = 3, rows: int = 5) -> DataFrame:
    """(view_name, row_no, row): the first rows of the first views, as JSON."""
    parts = []
    for name in sorted(views)[:first_views]:
        view = views[name]
        order = [F.col(f"`{c}`").asc_nulls_last() for c in view.columns]
        head = view.orderBy(*order).limit(rows)
        numbered_rows = head.withColumn("_no", F.row_number().over(W.orderBy(*order)))
        parts.append(
            numbered_rows.select(
                F.lit(name).alias("view_name"),
                F.col("_no").alias("row_no"),
                F.to_json(F.struct(*view.columns), {"ignoreNullFields": "false"}).alias("row"),
            )
        )
    return union_all(parts)


def schema_rows(spark: SparkSession, catalog: Mapping[str, tuple[str, str, DataFrame]]) -> DataFrame:
    """One row per column of the given tables: table key -> (view, file, frame).

    From the frames' schemas; reads no data.
    """
    rows = [
        (key, view, file, n, f.name, TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString()), False, False)
        for key, (view, file, df) in sorted(catalog.items())
        for n, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(rows, SCHEMA_ROWS)


SCHEMA_ROWS = T.StructType(
    [
        T.StructField("table_key", T.StringType()),
        T.StructField("view_name", T.StringType()),
        T.StructField("original_filename", T.StringType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("column_type", T.StringType()),
        T.StructField("notnull", T.BooleanType()),
        T.StructField("pk", T.BooleanType()),
    ]
)


def inferred_schema_rows(views: Mapping[str, DataFrame]) -> DataFrame:
    """(view_name, position, column_name, column_type, notnull, pk) inferred from the values."""
    return union_all(
        [
            inferred_types(as_text(view)).select(
                F.lit(name).alias("view_name"), "position", "column_name", "column_type", "notnull", "pk"
            )
            for name, view in sorted(views.items())
        ]
    )


def schema_document(rows: DataFrame) -> DataFrame:
    """Schema rows nested per table in column order, as the JSON schema document has them.

    The columns of ``rows`` beside those of a table's column tell the tables apart.
    """
    of_column = ("position", "column_name", "column_type", "notnull", "pk")
    tables = [c for c in rows.columns if c not in of_column]
    column = F.struct("position", F.col("column_name").alias("name"), F.col("column_type").alias("type"), "notnull", "pk")
    nested = rows.groupBy(*tables).agg(F.array_sort(F.collect_list(column)).alias("columns"))
    plain = F.transform("columns", lambda c: F.struct(*[c[n].alias(n) for n in ("name", "type", "notnull", "pk")]))
    return nested.withColumn("columns", plain)


def schema_csv_rows(documents: DataFrame) -> DataFrame:
    """A nested schema document back to one row per column, under the report's header."""
    flat = documents.select("table_key", "view_name", "original_filename", F.explode("columns").alias("c"))
    return flat.select(
        "table_key", "view_name", "original_filename", "c.name", "c.type", "c.notnull", "c.pk"
    ).toDF(*fv.SCHEMA_CSV_HEADER)
