"""Vectors that are kept: a text is embedded once by each embedder.

A store is a folder of batches. A vector is found by the embedder's name and the md5 of its text. New texts are embedded
in batches of bounded size, and each batch is published when it is complete (see ``published``), so a build that breaks
midway keeps the batches it finished and repeats none of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spendlens.operators.documents import Embedder, TrigramEmbedder, embed
from spendlens.operators.skew import spread_join
from spendlens.sources import published

BATCH_TEXTS = 1_000_000
VECTORS = "text_md5 string, embedder string, embedding array<float>"


def vectors(spark: SparkSession, folder: str, embedder: Embedder) -> DataFrame:
    """text_md5 and embedding of all published batches by this embedder."""
    batches = published.every(spark, folder)
    kept = spark.read.schema(VECTORS).parquet(*batches) if batches else spark.createDataFrame([], VECTORS)
    return kept.where(F.col("embedder") == embedder.name).select("text_md5", "embedding").dropDuplicates(["text_md5"])


def add_texts(texts: DataFrame, folder: str, embedder: Embedder, text: str = "document", batch_texts: int = BATCH_TEXTS) -> int:
    """Embed the texts that the store does not hold; gives how many those were."""
    spark = texts.sparkSession
    plain = F.coalesce(F.col(text), F.lit(""))
    distinct = texts.select(plain.alias("text")).distinct().withColumn("text_md5", F.md5("text"))
    new = distinct.join(vectors(spark, folder, embedder).select("text_md5"), "text_md5", "left_anti")
    new = published.stored(new, "new-texts")  # found once, whatever the number of batches
    batches = -(-new.count() // batch_texts)
    if batches > 1:
        # a batch is read from its own folder; its rows are dealt to several tasks by their md5
        batch = F.pmod(F.xxhash64("text_md5"), F.lit(batches)).cast("int")
        dealt = new.withColumn("batch", batch).repartition("batch", F.substring("text_md5", 1, 1))
        new = published.stored(dealt, "new-texts", by="batch")
    embedded = 0
    for k in range(batches):
        part = new.where(F.col("batch") == k).drop("batch") if batches > 1 else new
        batch, seen = published.new_build(folder), Observation()
        rows = embed(part, embedder, "text").select("text_md5", "embedder", "embedding").observe(seen, F.count(F.lit(1)).alias("n"))
        rows.write.parquet(batch)
        embedded += seen.get["n"]
        published.publish(spark, folder, batch, {"embedder": embedder.name, "texts": seen.get["n"]})
    return embedded


def kept_vectors(folder: str, embedder: Embedder | None = None, batch_texts: int = BATCH_TEXTS) -> Callable[[DataFrame], DataFrame]:
    """A function that adds ``embedding`` and ``embedder`` like ``embed``, from the store; new texts are added to it first."""
    embedder = embedder or TrigramEmbedder()

    def embedded(df: DataFrame, text: str = "document") -> DataFrame:
        add_texts(df, folder, embedder, text, batch_texts)
        key = F.md5(F.coalesce(F.col(text), F.lit("")))
        found = spread_join(df.withColumn("text_md5", key), vectors(df.sparkSession, folder, embedder), ["text_md5"])
        return found.drop("text_md5").withColumn("embedder", F.lit(embedder.name))

    return embedded
