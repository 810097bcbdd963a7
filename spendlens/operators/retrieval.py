"""Nearest documents to a question, and what follows from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.functions.columns import first_asc
from spendlens.operators.documents import Embedder, TrigramEmbedder, embed
from spendlens.operators.knn_join import knn_join
from spendlens.operators.lookup import top_payees

TOP = 10


def squared_distance(vector: Column, query: Sequence[float]) -> Column:
    """Squared Euclidean distance to a fixed vector, NULL for a missing one.

    A stored vector of another length is an error: it was made by something else.
    """
    numbers = [float(q) for q in query]
    fixed = F.array(*[F.lit(q) for q in numbers])
    gaps = F.zip_with(vector, fixed, lambda a, b: a.cast("double") - b)
    total = F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap * gap)
    message = F.concat(
        F.lit(f"the question has {len(numbers)} dimensions, a stored vector "), F.size(vector).cast("string")
    )
    return (
        F.when(vector.isNull(), F.lit(None))
        .when(F.size(vector) == len(numbers), total)
        .otherwise(F.raise_error(message).cast("double"))
    )


def query_vector(store: DataFrame, id_column: str, value: int | str, vector: str = "embedding") -> list[float]:
    """One stored vector as numbers, to search with."""
    row = store.where(F.col(id_column) == F.lit(value)).select(vector).first()
    if row is None:
        raise ValueError(f"no vector with {id_column} = {value!r}")
    return [float(x) for x in row[0]]


def nearest(
    store: DataFrame, query: Sequence[float], id_column: str, k: int = TOP, vector: str = "embedding"
) -> DataFrame:
    """The k rows nearest to the query: every task keeps its own k, one task merges them.

    Equal distances are ordered by id.
    """
    return store.withColumn("distance", squared_distance(F.col(vector), query)).orderBy(*first_asc("distance", id_column)).limit(k)


def ask(store: DataFrame, question: str, embedder: Embedder | None = None, k: int = TOP) -> DataFrame:
    """Nearest documents to a question; refuses a store made by another embedder."""
    embedder = embedder or TrigramEmbedder()
    query = [float(x) for x in embedder([question])[0].astype("float32")]
    return nearest(_made_by(store, embedder), query, "doc_id", k)


def ask_many(store: DataFrame, questions: DataFrame, embedder: Embedder | None = None, k: int = TOP) -> DataFrame:
    """Nearest documents to every question of a table (``question_id``, ``question``): one exact join by pivots.

    Gives question_id, rank, the columns of the hits without their vectors, and their distance; squared, as ``ask`` does.
    """
    embedder = embedder or TrigramEmbedder()
    asked = embed(questions.select("question_id", "question"), embedder, "question")
    hits = knn_join(_made_by(store, embedder), asked, "doc_id", "question_id", k)
    texts = store.drop("embedding", "embedder").join(hits, "doc_id")
    return texts.withColumn("distance", F.col("distance") * F.col("distance"))


def _made_by(store: DataFrame, embedder: Embedder) -> DataFrame:
    """The store; its vectors are an error where another embedder made them."""
    message = F.concat(F.lit(f"the question is embedded with {embedder.name}, the store with "), F.col("embedder"))
    checked = F.when(F.col("embedder") == embedder.name, F.col("embedding")).otherwise(
        F.raise_error(message).cast("array<float>")
    )
    return store.withColumn("embedding", checked)


def context(hits: DataFrame, id_column: str, text_column: str, order: Sequence[str], k: int = TOP) -> DataFrame:
    """One row: sorted distinct ids of the first k hits and their texts as a bullet list."""
    hits = hits.orderBy(*first_asc(*order)).limit(k)
    ordered = F.sort_array(F.collect_list(F.struct(*order, F.col(text_column).alias("_text"))))
    bullets = F.transform(ordered, lambda hit: F.concat(F.lit("- "), hit["_text"]))
    return hits.agg(
        F.sort_array(F.collect_set(id_column)).alias("ids"), F.array_join(bullets, "\n").alias("context")
    )


def retrieved_top_payees(detail: DataFrame, hits: DataFrame, id_column: str = "project_id", n: int = 3) -> DataFrame:
    """The n payees that got most within the projects of the hits."""
    return top_payees(detail, hits.select(F.col(id_column).alias("project_id")), n)
