"""Documents as files of token ids, and these files read back.

Documents are ordered by doc_id over ranges; each range becomes one file (see ``token_file``) in a folder that all
executors share, opened through Arrow's file systems. A file's name holds its task attempt, and the list of files
names the attempts that ended well: one that is lost leaves a file that nobody reads.

Cases: a null or empty text has only the end id. Rows without doc_id come first. Repeated rows are written as often
as they come, ordered by text. Extra columns are ignored. An empty table writes nothing and reads as no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendlens.llm import common, token_file
from spendlens.llm.tokens import VOCABULARY, encoder
from spendlens.session import apply_settings

END_ID = 0

FILES = "part long, path string, n_docs long, n_ids long"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system for a path as Hadoop writes it."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def write_files(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Write all documents in ascending order of doc_id; gives the list of files (part, path, n_docs, n_ids)."""
    end = end_id.to_bytes(4, "little")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
        encode = encoder(vocabulary).encode
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield token_file.NO_ID if doc_id is None else doc_id, encode(text or "") + end

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return

        def all_batches() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        context = TaskContext.get()
        path = f"{folder}/part-{context.partitionId():06d}-{context.taskAttemptId()}.zst"
        store, place = _open(path)
        store.create_dir(place.rpartition("/")[0], recursive=True)
        with store.open_output_stream(place, compression=None) as out:
            n_docs, n_ids = token_file.write(out, encoded(all_batches()))
        yield pa.RecordBatch.from_pylist(
            [{"part": context.partitionId(), "path": path, "n_docs": n_docs, "n_ids": n_ids}],
            schema=pa.schema([("part", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]),
        )

    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(partitions, "doc_id")
    rows = rows.sortWithinPartitions("doc_id", "text")
    return common.kept(common.through_arrow(rows, write, FILES))


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            store, place = _open(path)
            with store.open_input_file(place) as source:
                reader = token_file.Reader(source)
                for i in range(len(reader.frames)):
                    rows = []
                    for doc_id, ids in reader.frame(i):
                        rows.append((None if doc_id == token_file.NO_ID else doc_id, start, len(ids) // 4, zlib.crc32(ids)))
                        start += len(ids) // 4
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(column, pa.int64()) for column in zip(*rows)], names=["doc_id", "start", "n_tokens", "ids_crc32"]
                    )


def read_files(files: DataFrame) -> DataFrame:
    """What the files hold, per document: doc_id, start (ids before it), n_tokens, ids_crc32."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = files.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))
    partitions = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(partitions, "path").mapInArrow(_read_batches, READ)


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Write the documents below the shared folder and read them back."""
    folder = common.shared_folder(docs.sparkSession, "token-ids")
    return read_files(write_files(docs, folder, vocabulary))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_settings(spark)
    return round_trip(common.read(spark, sf_dir, "documents"))
