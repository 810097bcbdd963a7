"""Texts are embedded once: a second build, a changed document, other embedders, a build that breaks midway."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlens.operators import documents
from spendlens.plans import registry
from spendlens.sources import embedding_store, published
from tests.conftest import SF_DIR
from tests.helpers import tuples


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, document string")


def test_only_new_texts_are_embedded(spark, tmp_path):
    folder, embedder = str(tmp_path), documents.TrigramEmbedder(16)
    texts = [f"text {i % 50}" for i in range(120)] + [None, ""]
    add = lambda df: embedding_store.add_texts(df, folder, embedder)
    assert add(table(spark, texts)) == 51 and add(table(spark, texts)) == 0
    assert add(table(spark, ["changed", *texts[1:]])) == 1
    assert len(published.every(spark, folder)) == 2
    assert embedding_store.add_texts(table(spark, texts), folder, documents.TrigramEmbedder(8)) == 51


def test_same_rows_as_embedding_everything(spark, tmp_path):
    embedder = documents.TrigramEmbedder(16)
    df = table(spark, ["a text", "another text", "a text", None, ""])
    kept = embedding_store.kept_vectors(str(tmp_path), embedder, batch_texts=2)
    got = kept(df)
    assert sorted(got.columns) == ["document", "embedder", "embedding", "id"]
    assert sorted(tuples(got, "id", "embedding")) == sorted(tuples(documents.embed(df, embedder), "id", "embedding"))


class Failing(documents.TrigramEmbedder):
    def __call__(self, texts):
        if "text 7" in texts:
            raise RuntimeError("no answer")
        return super().__call__(texts)


def test_finished_batches_stay(spark, tmp_path):
    folder = str(tmp_path)
    df = table(spark, [f"text {i}" for i in range(40)])
    with pytest.raises(Exception, match="no answer"):
        embedding_store.add_texts(df, folder, Failing(16), batch_texts=5)
    embedder = documents.TrigramEmbedder(16)
    done = embedding_store.vectors(spark, folder, embedder).count()
    assert embedding_store.add_texts(df, folder, embedder, batch_texts=5) == 40 - done < 40 or done == 0
    assert embedding_store.vectors(spark, folder, embedder).count() == 40


def test_store_is_built_once(spark, monkeypatch):
    first = registry.store_of(spark, SF_DIR)
    calls = []
    monkeypatch.setattr(documents, "vector_store_rows", lambda *a, **k: calls.append(1))
    again = registry.store_of(spark, SF_DIR)
    assert not calls and sorted(first.inputFiles()) == sorted(again.inputFiles())
    plan = registry.queries()["ask_documents"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "lineitem" not in plan
    vector = np.array(again.select("embedding").first()[0])
    assert vector.shape == (64,) and again.where(F.size("embedding") != 64).isEmpty()


def test_the_input_is_read_once_for_many_batches(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = table(spark, [f"text {i}" for i in range(60)])
    texts = rows.mapInArrow(counted, rows.schema)
    embedder = documents.TrigramEmbedder(16)
    assert embedding_store.add_texts(texts, str(tmp_path), embedder, batch_texts=10) == 60
    assert seen.value == 60
    assert embedding_store.vectors(spark, str(tmp_path), embedder).count() == 60
