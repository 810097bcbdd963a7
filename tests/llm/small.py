"""Small tables for the tests of the training-data operators."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, first=0, lang="en", source="s"):
    """A documents table; a text may be None, an item (doc_id, text) or (doc_id, text, lang, source)."""
    rows = []
    for i, item in enumerate(texts):
        doc_id, text, *rest = item if isinstance(item, tuple) else (first + i, item)
        la, so = rest if rest else (lang, source)
        rows.append((doc_id, text, la, so, len(text or "")))
    return spark.createDataFrame(rows, DOCS)


def prose(seed, n, vocabulary=2000):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


def with_clash(docs):
    """Extra columns whose names operators may use inside."""
    from pyspark.sql import functions as F

    for name in ("doc", "component", "words", "score", "_score", "_n", "host", "key", "bucket", "row", "signature", "_kept", "_factor", "_topic", "_gone", "_drawn", "given 0", "a.b"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs


def as_dict(df, key="doc_id"):
    return {r[key]: r.asDict(recursive=True) for r in df.collect()}
