"""From raw documents to files of token ids.

Each stage takes (spark, docs, folder of the tables) and returns the documents it keeps, with their columns; the last
returns what its files hold. Between stages the documents are written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendlens.llm import common, decontaminate, mixing, near_dedup, token_output, toxicity
from spendlens.session import apply_settings

# close to the natural shares, so that few documents go
MIX_POWERS = {"source": 0.9, "lang": 0.9, "topic": 1.0}
MIX_SHARE = 0.8  # of the tokens stay, however rare the rarest source is


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; learnt from the labelled documents of the folder."""
    apply_settings(spark)
    return toxicity.keep_clean(docs, common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    apply_settings(spark)
    return near_dedup.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    apply_settings(spark)
    return decontaminate.keep_clean(docs, common.read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources and languages come closer to each other."""
    apply_settings(spark)
    return mixing.keep_drawn(docs, MIX_POWERS, share=MIX_SHARE)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents in files, as read back: doc_id, start, n_tokens, ids_crc32."""
    apply_settings(spark)
    return token_output.round_trip(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
    ("token_output", write_token_ids),
]

ORACLE_SQL = None  # SQL has no tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = common.kept(stage(spark, docs, sf_dir))
    _, last = STAGES[-1]
    return last(spark, docs, sf_dir)
