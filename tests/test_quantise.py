"""Quantised vectors against numpy, and records that are chosen by number."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_knn import as_set, frame

from exactnn.operators import quantise as Q
from exactnn.sources import xvec as S


def test_scalar_types(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(200, 6)).astype(np.float32)
    v[:, 3] = 2.5
    df = frame(spark, range(200), v, "id")
    low, high = v.min(axis=0).astype(float), v.max(axis=0).astype(float)
    step = (high - low) / 255
    want = np.where(step > 0, np.floor((v - low) / np.where(step > 0, step, 1)), 0).clip(0, 255)
    ranges = Q.calibrate(df)
    for dtype, shift in (("uint8", 0), ("int8", 128)):
        got = {r.id: r.q for r in df.select("id", Q.scalar_quantised("embedding", ranges, dtype).alias("q")).collect()}
        assert (np.array([got[i] for i in range(200)]) == want - shift).all()
    wide = df.withColumn("embedding", F.transform("embedding", lambda x: x * 10))
    outside = [x for r in wide.select(Q.scalar_quantised("embedding", ranges).alias("q")).collect() for x in r.q]
    assert min(outside) == -128 and max(outside) == 127
    tail = {r.pos: (r.low, r.high) for r in Q.calibrate(df, tail=0.1).collect()}
    for i in (0, 5):
        ordered = np.sort(v[:, i])
        assert ordered[17] <= tail[i][0] <= ordered[22] and ordered[177] <= tail[i][1] <= ordered[182]
    with pytest.raises(ValueError):
        Q.scalar_quantised("embedding", ranges.where("pos <> 2"))


def test_bits_and_neighbours(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(300, 40)).astype(np.float32)
    v[rng.permutation(300)[:100]] = v[0]
    v[5] = 0
    df = frame(spark, range(300), v, "id")
    bits = v > 0
    for dtype, shift in (("ubinary", 0), ("binary", 128)):
        packed = df.select("id", Q.bit_quantised("embedding", dtype).alias("embedding"))
        got = {r.id: r.embedding for r in packed.collect()}
        assert (np.array([got[i] for i in range(300)]) == np.packbits(bits, axis=1).astype(int) - shift).all()
        base = packed.withColumnRenamed("id", "base_id").repartition(4, "base_id")
        query = packed.withColumnRenamed("id", "query_id").where("query_id < 60")
        away = (bits[:60, None] != bits[None]).sum(axis=2)
        want = {
            (i, rank, int(j), float(away[i, j]))
            for i in range(60) for rank, j in enumerate(np.lexsort((np.arange(300), away[i]))[:9])
        }
        assert as_set(Q.knn_hamming(query, base, 9)) == want
        assert as_set(Q.knn_hamming(query, base, 9, resident=100, base_tasks=2)) == want
    assert df.select(Q.bit_quantised(F.slice("embedding", 1, 39)).alias("q")).where("q is not null").count() == 0
    assert Q.knn_hamming(query.limit(0), base, 3).count() == 0


def _nearest(words, asked, ids, k):
    away = np.bitwise_count(asked[:, None] ^ words).sum(axis=2)
    return [[(int(away[i, j]), int(ids[j])) for j in np.lexsort((ids, away[i]))[:k]] for i in range(len(asked))]


@pytest.mark.parametrize("words, k, rows", [(1, 10, 2048), (1, 300, 700), (4, 3, 2051), (2, 5, 9), (1, 1, 1)])
def test_bits_are_ranked_from_small_counts(words, k, rows):
    """Counts take the smallest type, and any width, k and share of ties ranks as plain counting does."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, (rows, words), dtype=np.uint64)
    base[rng.random(rows) < 0.3] = base[0]
    ids = rng.permutation(rows) - 5
    asked = np.vstack([base[: min(rows, 40)], rng.integers(0, 1 << 63, (30, words), dtype=np.uint64)])
    bits = Q.differing_bits(asked, base)
    assert bits.dtype == (np.uint8 if words < 4 else np.uint16)
    assert (bits == np.bitwise_count(asked[:, None] ^ base).sum(axis=2)).all()
    top = Q.HammingTopK(np.arange(len(asked)), asked, k)
    for at in range(0, rows, 500):
        top.offer(ids[at:at + 500], base[at:at + 500])
    got = {q: list(zip(d, i)) for batch in top.batches() for q, i, d in zip(*(c.to_pylist() for c in batch.columns))}
    assert [got[q] for q in range(len(asked))] == _nearest(base, asked, ids, k)


def test_repeated_ids_and_bars_of_bits():
    """Of rows that share an id each is a candidate; rows beyond a known distance are left out."""
    words = np.array([[0], [1], [3], [7], [0]], np.uint64)
    top = Q.HammingTopK(np.array([9]), words[:1], 4, bar=np.array([2.0]))
    top.offer(np.array([1, 1, 1, 2, 1]), words)
    (batch,) = top.batches()
    assert batch.column(1).to_pylist() == [[1, 1, 1, 1]] and batch.column(2).to_pylist() == [[0.0, 0.0, 1.0, 2.0]]


def test_records_choose_what_is_read(spark, tmp_path):
    path = str(tmp_path / "v.fvec")
    v = np.arange(4000, dtype=np.float32).reshape(1000, 4)
    S.write_xvec(frame(spark, range(1000), v, "idx"), path, vector="embedding")
    assert S.read_xvec(spark, path, splitBytes=400).rdd.getNumPartitions() > 40
    for options, want, slices in (
        ({"records": [123]}, [123], 1), ({"records": [5, 1, 2, -4, 5000]}, [1, 2, 5], 2), ({"records": []}, [], 1),
        ({"records": [1, 2, 700], "start": 2}, [2, 700], 2), ({"start": 995}, range(995, 1000), 1), ({"start": 20, "end": 10}, [], 1),
        ({"records": range(10), "splitBytes": 60}, range(10), 4),
    ):
        read = S.read_xvec(spark, path, **options)
        assert sorted((r.idx, r.vector[0]) for r in read.collect()) == [(i, 4.0 * i) for i in want], options
        assert read.rdd.getNumPartitions() == slices, options
