"""Texts go to the model once; a bad one costs no other its vector."""

import numpy as np
import pytest

from exactnn.operators.embed import hashing_embedder
from exactnn.operators.vector_store import VectorStore

DIM = 16


@pytest.fixture
def calls(spark):
    return spark.sparkContext.accumulator(0)


def _factory(calls, bad=()):
    def build():
        embed = hashing_embedder(DIM)()

        def run(texts, input_type=None):
            calls.add(len(texts))
            if any(t in bad for t in texts):
                raise RuntimeError("refused")
            return embed(texts, input_type)

        return run

    return build


def _rows(df):
    return sorted(((r.id, r.text, tuple(r.embedding), r.ok) for r in df.collect()), key=repr)


def test_second_run_calls_no_model(spark, tmp_path, calls):
    texts = [f"text {i % 40} of some words" for i in range(300)] + ["", None, "é 漢"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(4)
    store = VectorStore(spark, str(tmp_path / "store"))
    first = _rows(store.embed(df, "text", _factory(calls), DIM, model="m/x", flag="ok"))
    assert len(first) == len(texts) and calls.value == 42  # distinct ones, null as the empty one
    again = _rows(VectorStore(spark, str(tmp_path / "store")).embed(df, "text", _factory(calls), DIM, model="m/x", flag="ok"))
    assert again == first and calls.value == 42
    embed = hashing_embedder(DIM)()
    for _, text, vector, ok in first:
        assert ok and (not text or np.allclose(vector, embed([text], None)[0], atol=1e-6))
    more = df.unionByName(spark.createDataFrame([(900, "new"), (901, "new")], "id int, text string"))
    assert store.embed(more, "text", _factory(calls), DIM, model="m/x").count() == len(texts) + 2
    assert calls.value == 43
    store.embed(df, "text", _factory(calls), DIM, model="m/x", role="query").count()  # another role has vectors of its own
    assert calls.value == 43 + 42


def test_only_bad_texts_fail(spark, tmp_path, calls):
    texts = [f"text {i}" for i in range(200)]
    bad = {"text 3", "text 77", "text 78"}
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "id int, text string, _hash int").coalesce(1)
    store = VectorStore(spark, str(tmp_path / "store"))
    found = store.embed(df, "text", _factory(calls, bad), DIM, model="m", flag="ok")
    assert found.columns == ["id", "text", "_hash", "embedding", "ok"]
    for _, text, vector, ok in _rows(found):
        assert ok == (text not in bad) and not (any(vector) and text in bad)
    assert sum(any(r[2]) for r in _rows(found)) > 150
    known = calls.value
    assert _rows(store.embed(df, "text", _factory(calls), DIM, model="m", flag="ok")) == _rows(found) and calls.value == known
    store.add(df, "text", _factory(calls), DIM, model="m", retry=True)
    assert calls.value == known + 3


def test_no_texts(spark, tmp_path, calls):
    df = spark.createDataFrame([], "id int, text string")
    store = VectorStore(spark, str(tmp_path / "store"))
    assert store.vectors("m", None, DIM).count() == 0
    assert store.embed(df, "text", _factory(calls), DIM, model="m").count() == 0 and calls.value == 0
