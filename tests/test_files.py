import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from exactnn.functions import vectors as V
from exactnn.operators.ranking import merge_topk
from exactnn.plans.vector_tables import paged_table, sort_table, split_table
from exactnn.session import scratch_path
from exactnn.sources import blocks as BF
from exactnn.sources import bundle as B
from exactnn.sources import tables as T
from exactnn.sources import xvec as S
from exactnn.sources.naming import Naming


def record(values, code):
    return struct.pack("<i", len(values)) + struct.pack(f"<{len(values)}{code}", *values)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    data = rng.standard_normal((300, 7)).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    return data, spark.createDataFrame(rows, "idx long, vector array<float>").repartition(5)


@pytest.mark.parametrize("single", (False, True))
def test_bytes_of_fvec(spark, tmp_path, vectors, single):
    data, df = vectors
    path = tmp_path / "v.fvec"
    S.write_xvec(df, str(path), single_file=single)
    written = path.read_bytes() if single else b"".join(
        p.read_bytes() for p in sorted(path.glob("*.fvec"))
    )
    assert written == b"".join(record(v.tolist(), "f") for v in data)
    assert not list(tmp_path.glob("*.tmp-*"))
    back = S.read_xvec(spark, str(path), splitBytes=100).orderBy("idx").collect()
    np.testing.assert_array_equal(np.array([r.vector for r in back], np.float32), data)
    assert [r.idx for r in back] == list(range(300))


def test_file_made_elsewhere(spark, tmp_path):
    path = tmp_path / "n.ivec"
    path.write_bytes(b"".join(record([i, -i, 2**31 - 1], "i") for i in range(10)))
    got = S.read_xvec(spark, str(path), "ivec", splitBytes=33)
    assert [(r.idx, r.vector) for r in got.orderBy("idx").collect()] == [
        (i, [i, -i, 2**31 - 1]) for i in range(10)
    ]
    assert tuple(S.count_vectors(spark, str(path), "ivec").first()) == (10, 3)
    assert S.nth_vector(spark, str(path), 7, "ivec").first().vector == [7, -7, 2**31 - 1]
    assert S.first_vector(spark, str(path), "ivec").vector[0] == 0
    assert S.nth_vector(spark, str(path), 10, "ivec").count() == 0


def test_bad_files(spark, tmp_path):
    short, mixed = tmp_path / "short.fvec", tmp_path / "mixed.fvec"
    short.write_bytes(record([1.0, 2.0], "f")[:-1])
    mixed.write_bytes(record([1.0, 2.0, 3.0], "f") + record([1.0, 2.0], "f") + b"\0\0\0\0")
    for path in (short, mixed):
        with pytest.raises(Exception, match="multiple|dimension"):
            S.read_xvec(spark, str(path)).count()


def test_write_refuses_mixed_dimensions(spark, tmp_path):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0])], "idx long, vector array<float>")
    with pytest.raises(Exception, match="dimension|components"):
        S.write_xvec(df, str(tmp_path / "x.fvec"))
    assert not (tmp_path / "x.fvec").exists()


def test_single_file_needs_dense_positions(spark, tmp_path):
    df = spark.createDataFrame([(0, [1.0]), (2, [1.0])], "idx long, vector array<float>")
    with pytest.raises(Exception, match="dense"):
        S.write_xvec(df, str(tmp_path / "x.fvec"), single_file=True)


def test_modes(spark, tmp_path, vectors):
    _, df = vectors
    path = str(tmp_path / "m.fvec")
    S.write_xvec(df, path)
    S.write_xvec(df.where("idx < 5"), path, mode="ignore")
    assert S.read_xvec(spark, path).count() == 300
    with pytest.raises(FileExistsError):
        S.write_xvec(df, path, mode="error")
    S.write_xvec(df.where("idx < 5"), path)
    assert S.read_xvec(spark, path).count() == 5


def test_empty_dataset(spark, tmp_path, vectors):
    _, df = vectors
    for single in (False, True):
        path = str(tmp_path / f"empty{single}.fvec")
        S.write_xvec(df.where("idx < 0"), path, single_file=single)
        assert S.read_xvec(spark, path).count() == 0
        assert tuple(S.count_vectors(spark, path).first()) == (0, 0)


def test_import_of_positional_blocks(spark, tmp_path):
    """Block files of an older run: row position is the query, RowNum is to be ignored."""
    rng = np.random.default_rng(2)
    expected = [[] for _ in range(50)]
    for block in range(3):
        ids = rng.integers(0, 100_000, (50, 10))
        gaps = rng.random((50, 10)).round(6)
        for q in range(50):
            expected[q] += zip(gaps[q], ids[q])
        names = [str(i) for i in range(10)]
        pd.DataFrame(ids, columns=names).assign(RowNum=range(50)).to_parquet(
            tmp_path / f"indices{block}.parquet"
        )
        pd.DataFrame(gaps, columns=[f"embedding_{i}" for i in range(10)]).assign(
            RowNum=range(50)
        ).to_parquet(tmp_path / f"distances{block}.parquet")
    pd.DataFrame({"0": [1]}).to_parquet(tmp_path / "final_indices.parquet")
    assert T.block_count(spark, str(tmp_path)) == 3
    merged = merge_topk(T.import_blocks(spark, str(tmp_path)), 10).collect()
    got = {(r.query_id, r["rank"]): (r.distance, r.base_id) for r in merged}
    assert len(got) == 500
    for q in range(50):
        assert [got[q, i] for i in range(10)] == sorted(expected[q])[:10]


def test_wide_tables_and_positions(spark, tmp_path):
    rng = np.random.default_rng(4)
    data = rng.standard_normal((40, 12)).astype(np.float32)
    for part in range(2):
        frame = pd.DataFrame(
            data[20 * part:20 * part + 20], columns=[f"embedding_{i}" for i in range(12)]
        )
        frame.insert(0, "title", [f"t{i}" for i in range(20)])
        frame.to_parquet(tmp_path / f"part{part}.parquet")
    df = T.read_vectors(spark, str(tmp_path), ["title"], position="idx")
    rows = df.orderBy("idx").collect()
    assert [r.idx for r in rows] == list(range(40))
    np.testing.assert_array_equal(np.array([r.embedding for r in rows], np.float32), data)
    first = T.read_vectors(spark, str(tmp_path), [], position="idx", n=25)
    assert sorted(r.idx for r in first.collect()) == list(range(25))


def test_write_refuses_what_exists(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    T.write_vectors(spark.range(10), path, rows_per_file=3)
    with pytest.raises(AnalysisException):
        T.write_vectors(spark.range(99), path)
    T.write_vectors(spark.range(99), path, mode="ignore")
    assert spark.read.parquet(path).count() == 10


def test_bundle_types_and_encoding(spark, tmp_path):
    rows = [(i, [float(i), -float(i), 100.0]) for i in range(5)]
    vecs = spark.createDataFrame(rows, "idx long, vector array<float>")
    near = spark.createDataFrame([(i, [0, 1]) for i in range(5)], "idx long, vector array<long>")
    gaps = spark.createDataFrame(
        [(i, [0.0, 0.5]) for i in range(5)], "idx long, vector array<double>"
    )
    parts = {"train": vecs, "test": vecs, "neighbors": near, "distances": gaps}
    path = str(tmp_path / "b")
    B.write_bundle(parts, path, "ubinary")
    back = B.read_bundle(spark, path)
    field = back["train"].schema["vector"]
    assert field.dataType.elementType.simpleString() == "smallint"
    assert field.metadata == {"dtype": "ubinary", "encoding": "binary_uint8"}
    assert back["neighbors"].schema["vector"].dataType.elementType.simpleString() == "bigint"
    sizes = {r.part: (r.row_count, r.dim) for r in B.bundle_manifest(spark, path).collect()}
    assert sizes == {"train": (5, 3), "test": (5, 3), "neighbors": (5, 2), "distances": (5, 2)}


def test_too_many_positions_are_refused(spark):
    names = Naming("/none", "m", 2, 1, 2**31, 1)
    with pytest.raises(ValueError):
        B.export(spark, names, None, None, None, 2**31)


def test_names():
    n = Naming("knn", "intfloat/e5-base-v2", 768, 100, 1000, 10)
    assert n.home == "knn/intfloat_e5-base-v2/q100_b1000_k10"
    assert n.query_table == f"{n.home}/intfloat_e5-base-v2_768_query_vector_data_100.parquet"
    assert n.indices == f"{n.home}/intfloat_e5-base-v2_768_indices_b1000_q100_k10.ivec"
    assert n.partial("indices", 3) == f"{n.home}/partial/indices3.parquet"
    assert n.partial("distances") == f"{n.home}/partial/final_distances.parquet"
    typed = Naming("knn", "voyage-3-large", 1024, 1, 2, 3, "int8")
    assert typed.base_vectors.endswith("/voyage-3-large_1024_int8_base_vectors_2.fvec")


def test_table_jobs(spark, tmp_path, sf):
    source = f"{sf}/embeddings.parquet"
    wide = split_table(spark, source, str(tmp_path / "wide"))
    assert len(V.wide_names(wide)) == 64 and wide.columns[:3] == ["vec_id", "embedding", "label"]
    turns = f"{sf}/conversations.parquet"
    done = sort_table(spark, turns, str(tmp_path / "sorted"), ["role", "conv_id", "turn"])
    placed = done.select("role", "conv_id", "turn", F.input_file_name().alias("f"))
    keys = [tuple(r)[:3] for r in placed.orderBy("f").collect()]
    assert keys == sorted(keys)
    pages = paged_table(spark, turns, str(tmp_path / "pages"), ["conv_id", "turn"], 100)
    assert pages.where("page = 0").count() == 100
    assert pages.count() == spark.read.parquet(turns).count()


def test_files_on_a_cluster_with_a_plain_shared_folder(spark, tmp_path, vectors, monkeypatch):
    data, df = vectors
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    conf, get = type(spark.conf), type(spark.conf).get
    with monkeypatch.context() as patch:
        patch.setattr(conf, "get", lambda self, key, *a: str(tmp_path) if key == "spark.checkpoint.dir" else get(self, key, *a))
        path = scratch_path(spark, "v.fvec")
    assert path.startswith(f"file:{tmp_path}/")
    S.write_xvec(df, path)
    assert S.read_xvec(spark, path).count() == len(data)
    lists = spark.createDataFrame([(0, 0, [5], [0.5])], BF.BLOCK_SCHEMA)
    BF.write_blocks(lists, f"{tmp_path.as_uri()}/blocks", 1)
    assert BF.block_lists(spark, f"{tmp_path.as_uri()}/blocks").count() == 1
    with pytest.raises(ValueError, match="name the file system"):
        S.write_xvec(df, str(tmp_path / "plain.fvec"))
