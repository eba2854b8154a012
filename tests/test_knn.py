import functools

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from exactnn.functions import vectors as V
from exactnn.operators import knn as K
from exactnn.operators.knn import task_count
from exactnn.operators.ranking import as_arrays, as_wide, from_wide_pair, merge_topk
from exactnn.operators.topk import BlockTopK, drop_surplus_copies, merge_lists, ranked, vector_matrix

METRICS = ("sqeuclidean", "cosine", "inner")

# rounded before ranking, so that a plain computation in another order gives the same rows
knn_join = functools.partial(K.knn_join, decimals=6)
knn_partials = functools.partial(K.knn_partials, decimals=6)


def exact(q, b, metric, decimals=6):
    q, b = q.astype(np.float64), b.astype(np.float64)
    if metric == "sqeuclidean":
        d = ((q[:, None, :] - b[None, :, :]) ** 2).sum(-1)
    elif metric == "inner":
        d = 1 - q @ b.T
    else:
        scale = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :]
        d = 1 - np.divide(q @ b.T, scale, out=np.zeros_like(scale), where=scale > 0)
    if decimals is None:
        return d
    return np.floor(d * 10**decimals + 0.5) / 10**decimals + 0.0


def brute(q, b, k, metric, qids=None, bids=None):
    d = exact(q, b, metric)
    qids = np.arange(len(q)) if qids is None else qids
    bids = np.arange(len(b)) if bids is None else bids
    out = set()
    for i in range(len(q)):
        for rank, j in enumerate(np.lexsort((bids, d[i]))[:k]):
            out.add((int(qids[i]), rank, int(bids[j]), float(d[i, j])))
    return out


def frame(spark, ids, vectors, name):
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, f"{name} long, embedding array<float>")


def as_set(df):
    return {tuple(r) for r in df.collect()}


def unit(rng, n, d):
    x = rng.standard_normal((n, d)).astype(np.float32)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    return unit(rng, 100, 48), unit(rng, 1000, 48)


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("k", (1, 10, 100))
def test_both_forms_equal_brute_force(spark, data, metric, k):
    q, b = data
    query, base = frame(spark, range(100), q, "query_id"), frame(spark, range(1000), b, "base_id")
    expected = brute(q, b, k, metric)
    assert as_set(knn_join(query, base, k, metric)) == expected
    grid = knn_join(query, base, k, metric, strategy="grid")
    assert as_set(grid) == expected


@pytest.mark.parametrize("parts", (1, 3, 40))
def test_result_does_not_depend_on_partitions(spark, data, parts):
    q, b = data
    query = frame(spark, range(100), q, "query_id").repartition(parts)
    base = frame(spark, range(1000), b, "base_id").repartition(parts)
    expected = brute(q, b, 10, "sqeuclidean")
    assert as_set(knn_join(query, base, 10)) == expected
    assert as_set(knn_join(query, base, 10, base_tasks=2)) == expected


def test_one_vector_holds_a_third_of_the_base(spark):
    rng = np.random.default_rng(3)
    b = unit(rng, 900, 16)
    b[rng.permutation(900)[:300]] = b[0]
    q = np.vstack([b[:1], unit(rng, 20, 16)])
    bids = rng.permutation(900)
    query, base = frame(spark, range(21), q, "query_id"), frame(spark, bids, b, "base_id")
    expected = brute(q, b, 25, "sqeuclidean", bids=bids)
    assert as_set(knn_join(query, base, 25)) == expected
    grid = knn_join(query, base, 25, strategy="grid")
    assert as_set(grid) == expected


def test_fewer_base_rows_than_k(spark):
    rng = np.random.default_rng(1)
    q, b = unit(rng, 5, 8), unit(rng, 3, 8)
    query = frame(spark, range(5), q, "query_id")
    base = frame(spark, range(3), b, "base_id").repartition(6)
    for strategy in ("broadcast", "grid"):
        found = as_set(knn_join(query, base, 10, strategy=strategy))
        assert found == brute(q, b, 10, "sqeuclidean")


def test_zero_vectors_under_cosine(spark):
    q = np.array([[0, 0], [1, 0]], np.float32)
    b = np.array([[0, 0], [0, 1], [-1, 0], [2, 0]], np.float32)
    query, base = frame(spark, range(2), q, "query_id"), frame(spark, range(4), b, "base_id")
    assert as_set(knn_join(query, base, 3, "cosine")) == brute(q, b, 3, "cosine")


def test_empty_sides(spark, data):
    q, b = data
    query, base = frame(spark, range(100), q, "query_id"), frame(spark, range(1000), b, "base_id")
    assert knn_join(query.where("query_id < 0"), base, 5).count() == 0
    assert knn_join(query, base.where("base_id < 0"), 5).count() == 0
    assert knn_join(query, base.where("base_id < 0"), 5, strategy="grid").count() == 0


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("scale", (1e-3, 1.0, 300.0))
def test_kernel_on_any_scale(metric, scale):
    rng = np.random.default_rng(11)
    q = (rng.standard_normal((60, 33)) * scale).astype(np.float32)
    b = (rng.standard_normal((2500, 33)) * scale + scale).astype(np.float32)
    top = BlockTopK(np.arange(60), q, 20, metric, 6)
    for at in range(0, 2500, 400):
        top.offer(np.arange(at, min(at + 400, 2500)), b[at:at + 400])
    got = {}
    for batch in top.batches():
        for qid, bids, gaps in zip(*(c.to_pylist() for c in batch.columns)):
            got[qid] = list(zip(bids, gaps))
    d = exact(q, b, metric)
    for i in range(60):
        order = np.lexsort((np.arange(2500), d[i]))[:20]
        assert [x for x, _ in got[i]] == order.tolist()
        np.testing.assert_allclose([x for _, x in got[i]], d[i][order], rtol=1e-12, atol=1.1e-6)


@pytest.mark.parametrize("top_id", (50, 2**39, 2**62))
@pytest.mark.parametrize("scale", (1.0, 1e9))
def test_ranked_equals_lexsort(top_id, scale):
    rng = np.random.default_rng(8)
    rows = rng.integers(0, 20, 3000)
    dist = np.round((rng.integers(-4, 9, 3000) / 8) * scale, 6)
    dist[::17] = np.inf
    ids = rng.integers(-3 if top_id == 50 else 0, top_id, 3000)
    ids[::17] = np.iinfo(np.int64).max
    np.testing.assert_array_equal(ranked(rows, dist, ids), np.lexsort((ids, dist, rows)))
    order, plain = ranked(rows, dist, ids, 6), np.lexsort((ids, dist, rows))
    for values in (rows, dist, ids):
        np.testing.assert_array_equal(values[order], values[plain])


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("width, k", [(2048, 10), (2051, 40), (300, 60), (37, 5)])
def test_first_bar_and_hits_come_from_groups(monkeypatch, metric, width, k):
    """Any width and k, zero vectors, copies and ties rank as the full distances do; wide packs give their bar by groups."""
    from exactnn.operators import topk

    bars, bound = [], topk.kth_bound
    monkeypatch.setattr(topk, "kth_bound", lambda score, least, *rest: bars.append(least.shape[1]) or bound(score, least, *rest))
    rng = np.random.default_rng(4)
    b = rng.integers(-3, 4, (2 * width, 12)).astype(np.float32)
    b[::9], b[5] = b[3], 0
    q = np.vstack([b[:20], rng.standard_normal((30, 12)).astype(np.float32)])
    ids = rng.permutation(2 * width) - 4
    top = BlockTopK(np.arange(50), q, k, metric, 6)
    for at in (0, width):
        top.offer(ids[at:at + width], b[at:at + width])
    d = exact(q, b, metric)
    want = {i: ids[np.lexsort((ids, d[i]))[:k]].tolist() for i in range(50)}
    assert {r["query_id"]: r["base_ids"] for batch in top.batches() for r in batch.to_pylist()} == want
    assert bars and bars[0] == (width // 16 if width >= 256 else 0)


@pytest.mark.parametrize("metric", METRICS)
def test_screen_of_short_vectors(metric):
    rng = np.random.default_rng(8)
    q, b = (unit(rng, n, 32) * np.float32(1e-3) for n in (40, 4000))
    top, measured = BlockTopK(np.arange(40), q, 5, metric), []
    measure = top._measure
    top._measure = lambda tile, rows, *rest: measured.append(len(rows)) or measure(tile, rows, *rest)
    for at in range(0, 4000, 500):
        top.offer(np.arange(at, at + 500), b[at:at + 500])
    found = {r["query_id"]: r["base_ids"] for batch in top.batches() for r in batch.to_pylist()}
    d = exact(q, b, metric, None)
    assert found == {i: np.lexsort((np.arange(4000), d[i]))[:5].tolist() for i in range(40)}
    assert sum(measured) < 40 * 100


def test_lists_merge_across_batches():
    rng = np.random.default_rng(0)
    rows, expected = [], {}
    for query in range(30):
        for _ in range(rng.integers(1, 9)):
            ids = rng.permutation(1000)[:4].tolist()
            gaps = np.sort(rng.integers(0, 5, 4) / 8).tolist()
            rows.append((query, ids, gaps))
            expected.setdefault(query, []).extend(zip(gaps, ids))
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.list_(pa.int64())),
            pa.array([r[2] for r in rows], pa.list_(pa.float64())),
        ],
        names=["query_id", "base_ids", "distances"],
    )
    for step in (1, 3, 1000):
        pieces = [batch.slice(i, step) for i in range(0, len(rows), step)]
        got = [r for b in merge_lists(6)(iter(pieces)) for r in zip(*(c.to_pylist() for c in b.columns))]
        assert got == [
            (q, rank, i, d) for q in range(30) for rank, (d, i) in enumerate(sorted(expected[q])[:6])
        ]
    assert list(merge_lists(6)(iter([]))) == []


def test_task_count(spark, sf):
    base = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert task_count(base, 10, 64) == 8


def test_too_long_vectors_are_refused():
    top = BlockTopK(np.arange(2), np.full((2, 3), 1e19, np.float32), 1, "inner")
    with pytest.raises(ValueError, match="overflow"):
        top.offer(np.arange(2), np.ones((2, 3), np.float32))


def test_surplus_copies():
    ids = np.array([9, 4, 7, 1, 3])
    vectors = np.array([[1, 0], [1, 0], [0, 1], [1, -0.0], [1, 0]], np.float32)
    kept, rows = drop_surplus_copies(ids, vectors, 2)
    assert kept.tolist() == [7, 1, 3] and rows.shape == (3, 2)


@pytest.mark.parametrize("bad", ([[1.0, 2.0], [1.0]], [[1.0, 2.0], None], [[1.0, float("nan")]]))
def test_bad_vectors_are_refused(bad):
    with pytest.raises(ValueError):
        vector_matrix(pa.array(bad, pa.list_(pa.float32())), 2)


def test_arguments(spark, data):
    q, b = data
    query, base = frame(spark, range(100), q, "query_id"), frame(spark, range(1000), b, "base_id")
    with pytest.raises(ValueError):
        knn_join(query, base, 5, "manhattan")
    with pytest.raises(ValueError):
        knn_join(query, base, 0)
    with pytest.raises(ValueError):
        knn_join(query, base, 5, strategy="broadcast", broadcast_bytes=10)
    with pytest.raises(ValueError):
        mixed = query.unionByName(frame(spark, [1000], [[1.0]], "query_id"))
        knn_join(mixed, base, 5)


def test_column_distances_equal_the_kernel(spark, data):
    q, b = data
    query, base = frame(spark, range(100), q, "query_id"), frame(spark, range(1000), b, "base_id")
    for metric in METRICS:
        result = knn_join(query, base, 3, metric)
        pairs = result.join(query.withColumnRenamed("embedding", "q"), "query_id").join(
            base.withColumnRenamed("embedding", "b"), "base_id"
        )
        off = F.abs(V.distance("q", "b", metric) - F.col("distance")) > 1e-6
        assert pairs.where(off).count() == 0


def test_merge_of_any_blocks(spark, data):
    q, b = data
    query, base = frame(spark, range(100), q, "query_id"), frame(spark, range(1000), b, "base_id")
    partials = knn_partials(query, base, 10)
    assert as_set(merge_topk(partials, 10)) == brute(q, b, 10, "sqeuclidean")
    assert as_set(merge_topk(partials, 4)) == brute(q, b, 4, "sqeuclidean")


def test_base_is_not_shuffled_and_limits_reach_the_exchange(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    result = knn_join(
        e.withColumnRenamed("vec_id", "query_id"), e.withColumnRenamed("vec_id", "base_id"), 10
    )
    plan = result._jdf.queryExecution().executedPlan().toString()
    probe = plan[plan.index("BroadcastHashJoin"):plan.index("BroadcastExchange")]
    assert "Exchange" not in probe and "label" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    merged = merge_topk(knn_partials(
        e.withColumnRenamed("vec_id", "query_id"), e.withColumnRenamed("vec_id", "base_id"), 10
    ), 10)
    assert merged._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


def test_wide_round_trip(spark, data):
    q, b = data
    query, base = frame(spark, range(100), q, "query_id"), frame(spark, range(1000), b, "base_id")
    result = knn_join(query, base, 5)
    lists = as_arrays(result)
    indices = as_wide(lists, "neighbors", 5).withColumn("RowNum", F.col("query_id"))
    back = from_wide_pair(indices, as_wide(lists, "distances", 5))
    assert as_set(merge_topk(back.drop("pos"), 5)) == as_set(result)


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("scale", (1e-6, 1e-3, 1.0, 1e6))
def test_ranks_follow_full_distances(spark, data, metric, scale):
    """However close the distances, the k nearest are the k nearest."""
    q, b = (x * np.float32(scale) for x in data)
    query, base = frame(spark, range(100), q, "query_id"), frame(spark, range(1000), b, "base_id")
    d = exact(q, b, metric, None)
    for found in (
        K.knn_join(query, base, 5, metric),
        K.knn_join(query, base, 5, metric, strategy="grid"),
    ):
        rows = sorted(tuple(r) for r in found.collect())
        assert len(rows) == 500
        for i, rank, j, distance in rows:
            assert distance == pytest.approx(d[i, j], rel=1e-9, abs=1e-12 * scale**2)
            if metric == "sqeuclidean":
                assert j == np.argsort(d[i], kind="stable")[rank]


@pytest.mark.parametrize("resident, rows", [(1 << 29, 2048), (20_000, 16), (1, 7)])
def test_grid_reads_the_base_once(spark, data, monkeypatch, resident, rows):
    """One scan whatever the number of tiles and of resident parts, no shuffle of the base."""
    monkeypatch.setattr(K, "RESIDENT_BYTES", resident)
    monkeypatch.setattr(K, "block_rows", lambda dim: rows)
    q, b = data
    query, base = frame(spark, range(100), q, "query_id"), frame(spark, range(1000), b, "base_id")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    seen = base.mapInArrow(counted, base.schema)
    lists = K.knn_lists(query, seen, 10, strategy="grid", base_tasks=4)
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("MapInArrow") == 2
    found = K.knn_join(query, seen, 10, strategy="grid", base_tasks=4, decimals=6)
    assert as_set(found) == brute(q, b, 10, "sqeuclidean")
    assert read.value == len(b)


def test_large_query_sides_are_read_by_the_tile(spark, tmp_path, monkeypatch):
    assert K.QuerySize(100_000, 64).bytes(10) > K.BROADCAST_BYTES
    monkeypatch.setattr(K, "BLOCK_ROWS", 64)
    monkeypatch.setattr(K, "scratch_path", lambda spark, name: str(tmp_path / name))
    vectors = unit(np.random.default_rng(9), 2600, 4)
    query, base = frame(spark, range(2600), vectors, "query_id"), frame(spark, range(50), vectors[:50], "base_id")
    assert as_set(knn_join(query, base, 3, strategy="grid")) == brute(vectors, vectors[:50], 3, "sqeuclidean")
    tiles = [pq.ParquetFile(p).metadata.num_rows for p in (tmp_path / "tiles").glob("*.parquet")]
    assert sum(tiles) == 41 and max(tiles) <= 16


def test_later_tasks_return_less(spark, data, monkeypatch):
    """The k-th places of the first tasks bound what the others return."""
    monkeypatch.setattr(K, "BAR_TASKS", 1)
    q, b = data
    query, base = frame(spark, range(100), q, "query_id"), frame(spark, range(1000), b, "base_id").repartition(20, "base_id")
    places = lambda lists: lists.select(F.sum(F.size("base_ids"))).first()[0]
    grid = K.knn_lists(query, base, 10, strategy="grid", base_tasks=20, size=K.measure_queries(query))
    first = places(grid)  # tasks that start together do not see each other's bars
    assert places(grid) < first <= 20 * 100 * 10
    assert as_set(knn_join(query, base, 10, strategy="grid", base_tasks=20)) == brute(q, b, 10, "sqeuclidean")


def test_tasks_follow_the_splits_of_a_source_of_unknown_size(spark, tmp_path, data):
    from exactnn.sources import xvec as S

    path = str(tmp_path / "b.fvec")
    S.write_xvec(frame(spark, range(1000), data[1], "idx").withColumnRenamed("embedding", "vector"), path)
    base = S.read_xvec(spark, path, splitBytes=4000).withColumnRenamed("vector", "embedding")
    assert task_count(base, 10, 48) is None
    lists = K.knn_lists(frame(spark, range(100), data[0], "query_id"), base, 10, base_id="idx")
    assert lists.rdd.getNumPartitions() == base.rdd.getNumPartitions() > 20


@pytest.mark.parametrize("strategy", ("broadcast", "grid"))
def test_small_splits_of_a_source_of_unknown_size_share_tasks(spark, tmp_path, strategy):
    """Lists of many queries do not grow with the number of splits."""
    from exactnn.sources import xvec as S

    b, q, k = unit(np.random.default_rng(4), 1000, 4), unit(np.random.default_rng(5), 60_000, 4), 10
    base, query = frame(spark, range(1000), b, "base_id"), frame(spark, range(60_000), q, "query_id")
    S.write_xvec(base, str(tmp_path / "b.fvec"), vector="embedding", order="base_id")
    read = S.read_xvec(spark, str(tmp_path / "b.fvec"), splitBytes=400)
    read = read.withColumnsRenamed({"idx": "base_id", "vector": "embedding"})
    cores = spark.sparkContext.defaultParallelism
    lists = K.knn_lists(query, read, k, strategy=strategy)
    assert read.rdd.getNumPartitions() > 40 and lists.rdd.getNumPartitions() == cores
    assert lists.select(F.sum(F.size("base_ids"))).first()[0] <= cores * len(q) * k
    found, same = (knn_join(query, x, k, strategy=strategy, base_tasks=n) for x, n in ((read, None), (base, 1)))
    assert found.count() == len(q) * k and found.exceptAll(same).isEmpty()
