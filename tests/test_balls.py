"""Blocks that a query cannot reach are left out, and nothing else."""

import numpy as np
import pytest
from test_knn import as_set, brute, exact, frame

from exactnn.functions.vectors import METRICS
from exactnn.operators import balls as B


def _clusters(rng, n, dim, spread=0.05, clusters=12):
    points = rng.normal(size=(clusters, dim))
    points /= np.linalg.norm(points, axis=1)[:, None]
    return (points[rng.integers(clusters, size=n)] + spread * rng.normal(size=(n, dim))).astype(np.float32)


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("scale", (1e-5, 1.0, 1e5))
def test_fewer_than_half_of_the_pairs_are_scored(spark, metric, scale):
    rng = np.random.default_rng(4)
    both = _clusters(rng, 2300, 16) * np.float32(scale)
    q, b = both[:300], both[300:]
    query, base = frame(spark, range(300), q, "query_id"), frame(spark, range(2000), b, "base_id")
    balls = B.build_balls(base.repartition(5, "base_id"), metric, centres=24, rows_per_ball=50)
    assert balls.table.selectExpr("sum(row_count)", "max(row_count)").first() == (2000, 50)
    count = spark.sparkContext.accumulator(0)
    found = {r[:3] for r in as_set(B.knn_ball_join(query, balls, 7, count=count))}
    near = np.argsort(exact(q, b, metric, None), axis=1, kind="stable")[:, :7]
    assert found == {(i, rank, int(j)) for i, row in enumerate(near) for rank, j in enumerate(row)}
    assert 0 < count.value < 300 * 2000 / 2


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("resident, rows", [(1 << 29, 2048), (1500, 9)])
def test_ties_copies_and_zero_vectors(spark, monkeypatch, metric, resident, rows):
    """A third of the base is one vector, some are zero, and ids break ties."""
    monkeypatch.setattr(B, "block_rows", lambda dim: rows)
    rng = np.random.default_rng(6)
    b = np.round(_clusters(rng, 600, 8, clusters=4), 1)
    b[rng.permutation(600)[:200]] = b[0]
    b[rng.permutation(600)[:20]] = 0
    q = np.vstack([b[:40], np.zeros((1, 8), np.float32), _clusters(rng, 30, 8)]).astype(np.float32)
    bids = rng.permutation(600)
    query, base = frame(spark, range(len(q)), q, "query_id"), frame(spark, bids, b, "base_id")
    balls = B.build_balls(base, metric, centres=6, rows_per_ball=20)
    found = as_set(B.knn_ball_join(query, balls, 25, decimals=6, resident=resident))
    assert found == brute(q, b, 25, metric, bids=bids)


def test_empty_sides_and_few_rows(spark):
    rng = np.random.default_rng(2)
    q, b = _clusters(rng, 5, 8), _clusters(rng, 3, 8)
    query, base = frame(spark, range(5), q, "query_id"), frame(spark, range(3), b, "base_id")
    assert as_set(B.knn_ball_join(query, B.build_balls(base), 10, decimals=6)) == brute(q, b, 10, "sqeuclidean")
    assert B.knn_ball_join(query, B.build_balls(base.where("base_id < 0")), 10).count() == 0
    assert B.knn_ball_join(query.where("query_id < 0"), B.build_balls(base), 10).count() == 0
    with pytest.raises(ValueError):
        B.build_balls(base, "manhattan")
