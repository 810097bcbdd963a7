"""Token totals by source, language and tokenizer version, kept up to date by signed changes.

A change of a document holds what it counted before (nothing for an insert) and after (nothing for a delete); a
revision has both. A batch of changes is summed to one signed row per (source, lang, tokenizer) with partial sums on
the map side and committed as a table of its own below the store's folder. Totals are the sum over all committed
batches, so batches may come in any order. A batch counts only when its table is complete, and committing a batch
again is without effect, so a job that failed or was started twice is simply run again. Batches can be folded into one.

Cases: null source or language are values of their own. Null and empty texts count no tokens and one document.
Repeated rows count as often as they come. Groups whose documents are all gone have no row. Extra columns are
ignored. Without batches the totals are empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from spendlens.llm import common
from spendlens.llm.tokens import VOCABULARY, encoder
from spendlens.session import apply_settings

WORDS = "words/1"
PIECES = "byte_bpe_50k/1"
COUNTS = "doc_id long, source string, lang string, tokenizer string, digest binary, n_tokens long"
SIDE = "struct<source:string,lang:string,n_tokens:bigint>"
TOTALS = StructType([
    *(StructField(name, StringType()) for name in ("source", "lang", "tokenizer")), *(StructField(name, LongType()) for name in ("documents", "tokens")),
])


def counted(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """For each row and tokenizer version the number of tokens, and a digest of the text."""

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
            digests = pa.array([blake2b(t.encode(), digest_size=16).digest() for t in texts], pa.binary())
            numbers = {WORDS: [len(t.encode().split()) for t in texts], PIECES: [len(encode(t)) // 4 for t in texts]}
            for tokenizer, n in numbers.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c) for c in ("doc_id", "source", "lang")),
                        pa.array([tokenizer] * len(texts)), digests, pa.array(n, pa.int64()),
                    ],
                    names=["doc_id", "source", "lang", "tokenizer", "digest", "n_tokens"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), *(F.col(c).cast("string") for c in ("source", "lang", "text")))
    return common.through_arrow(rows, batches_of, COUNTS)


def _side(present: bool = True) -> Column:
    side = F.struct("source", "lang", "n_tokens") if present else F.lit(None)
    return side.cast(SIDE)


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select("tokenizer", _side(False).alias("before"), _side().alias("after"))


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select("tokenizer", _side().alias("before"), _side(False).alias("after"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Counts of the same documents before and after."""
    return deletes(old).unionByName(inserts(new))


class Rollup:
    """Committed batches of signed totals below one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _store(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def committed(self) -> list[str]:
        """Names of the complete batches that no fold has replaced."""
        store = self._store()
        if not store.exists(self._path("")):
            return []
        names = sorted(s.getPath().getName() for s in store.listStatus(self._path("")))
        whole = [n for n in names if store.exists(self._path(f"{n}/_SUCCESS"))]
        folds = [n for n in whole if n.startswith("fold-")]
        replaced = {line for n in folds for line in self._members(n)}
        return [n for n in whole if n not in replaced]

    def _members(self, fold: str) -> list[str]:
        rows = self.spark.read.schema("batch string").parquet(f"{self.folder}/{fold}/members").collect()
        return [r[0] for r in rows]  # one name per batch

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of changes; False if it is there already."""
        if batch.startswith("fold-") or "/" in batch or not batch:
            raise ValueError(f"not a name for a batch: {batch!r}")
        if self._seen(batch):
            return False
        signed = F.explode(F.array(
            F.struct(F.lit(-1).cast("long").alias("sign"), F.col("before").alias("side")),
            F.struct(F.lit(1).cast("long").alias("sign"), F.col("after").alias("side")),
        )).alias("c")
        rows = changes.select("tokenizer", signed).where("c.side IS NOT NULL")
        sums = rows.groupBy(F.col("c.side.source").alias("source"), F.col("c.side.lang").alias("lang"), "tokenizer").agg(
            F.sum("c.sign").alias("documents"), F.sum(F.col("c.sign") * F.col("c.side.n_tokens")).alias("tokens")
        )
        sums.write.mode("overwrite").parquet(f"{self.folder}/{batch}")
        return True

    def _seen(self, batch: str) -> bool:
        store = self._store()
        if store.exists(self._path(f"{batch}/_SUCCESS")):
            return True
        return any(batch in self._members(n) for n in self.committed() if n.startswith("fold-"))

    def fold(self, name: str) -> None:
        """Put all committed batches into one; the old ones no longer count."""
        parts = self.committed()
        members = [m for p in parts for m in ([p, *self._members(p)] if p.startswith("fold-") else [p])]
        target = f"{self.folder}/fold-{name}"
        self.spark.createDataFrame([(m,) for m in members], "batch string").write.mode("overwrite").parquet(f"{target}/members")
        self._sum(parts).write.mode("overwrite").parquet(f"{target}/rows")
        self._store().create(self._path(f"fold-{name}/_SUCCESS"), True).close()

    def _sum(self, names: list[str]) -> DataFrame:
        paths = [f"{self.folder}/{n}" + ("/rows" if n.startswith("fold-") else "") for n in names]
        rows = self.spark.read.schema(TOTALS).parquet(*paths) if paths else self.spark.createDataFrame([], TOTALS)
        sums = rows.groupBy("source", "lang", "tokenizer").agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return sums.where("documents <> 0 OR tokens <> 0")

    def totals(self) -> DataFrame:
        return self._sum(self.committed())


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """The rows whose text repeats a line, with the column ``cleaned``: each line once."""
    cleaned = F.array_join(F.array_distinct(F.split("text", "\n")), "\n")
    return docs.withColumn("cleaned", cleaned).where("cleaned <> text")


def maintained(docs: DataFrame, folder: str) -> DataFrame:
    """Totals after all documents came in, exact copies went, and repeated lines were taken out of the rest.

    Of equal texts the smallest doc_id stays, with all its rows; rows without doc_id stay. The second batch is sent
    twice, as after a lost reply.
    """
    spark, docs = docs.sparkSession, docs.select("doc_id", "source", "lang", "text")
    rollup = Rollup(spark, folder)
    counts = common.kept(counted(docs))
    rollup.commit("1-all", inserts(counts))
    first = counts.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("stays"))
    copies = counts.join(first, "digest").where("doc_id > stays")
    for _ in range(2):
        rollup.commit("2-copies", deletes(copies))
    gone = copies.select(F.col("doc_id").alias("_gone")).distinct()
    changed = without_repeated_lines(docs).join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
    named = changed.select("doc_id", "source", "lang", "text", "cleaned")
    rollup.commit("3-lines", revisions(counted(named), counted(named.withColumn("text", F.col("cleaned")))))
    return rollup.totals()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_settings(spark)
    return maintained(common.read(spark, sf_dir, "documents"), common.shared_folder(spark, "token-totals"))
