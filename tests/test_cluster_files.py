"""Queries that write vector or block files, on a cluster whose shared folder is given without a file system."""

import pytest

from __spark_entry__ import DIM, queries

NAMED = (
    "block_manifest", "ground_truth_checks", "ground_truth_e2e", "ground_truth_manifest", "ivec_roundtrip", "knn_from_fvec",
    "ground_truth_rerun", "table_samples", "xvec_count", "xvec_nth", "xvec_records", "token_truth_e2e", "xvec_roundtrip", "xvec_same_values",
)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A small table set of its own rows."""
    sf = tmp_path_factory.mktemp("tables").as_uri()
    texts = [". ".join(f"word{(i * 7 + j * j) % 97} of sentence {j} in {i}" for j in range(12)) + "." for i in range(60)]
    rows = {
        "embeddings": ([(i, [float((i * j) % 23 - 11) for j in range(1, DIM + 1)], i % 5) for i in range(150)], "vec_id long, embedding array<float>, label int"),
        "documents": ([(i, t, "en", f"s{i % 3}") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string"),
        "labels": ([(i, i % 2) for i in range(60)], "doc_id long, toxic int"),
        "benchmark": ([(i, t) for i, t in enumerate(texts)], "item_id long, text string"),
        "conversations": ([(i // 4, i % 4, "user", t) for i, t in enumerate(texts)], "conv_id long, turn int, role string, text string"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).coalesce(2).write.parquet(f"{sf}/{name}.parquet")
    return sf


@pytest.mark.parametrize("name", NAMED)
def test_finishes(spark, tables, tmp_path, monkeypatch, name):
    conf, get = type(spark.conf), type(spark.conf).get
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(conf, "get", lambda self, key, *a: str(tmp_path) if key == "spark.checkpoint.dir" else get(self, key, *a))
    assert queries()[name](spark, tables).count()
