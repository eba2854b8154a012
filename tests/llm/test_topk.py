"""Exact top-k against plain integer products."""

import math
import random

import pytest

from exactnn.llm import segment_topk
from exactnn.llm.queries import op10_exact_topk

SCHEMA = "vec_id long, embedding array<float>, part int, s string"


def _plain(queries, base, k):
    want = []
    valid = lambda v: v and all(x is not None and math.isfinite(x) for x in v)
    whole = lambda v: [math.floor(64 * x) for x in v]
    base = [(i, whole(v)) for i, v in base if i is not None and valid(v)]
    for i, v in queries:
        if i is None or not valid(v):
            continue
        q = whole(v)
        found = sorted(((-sum(a * b for a, b in zip(q, c, strict=True)), j) for j, c in base if j != i and len(c) == len(q)))
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(want)


@pytest.mark.parametrize("seed, parts", [(1, 5), (2, 40)])
def test_against_plain_products(spark, seed, parts):
    """Each partition makes blocks of its own, so many partitions are many cells."""
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.4) for _ in range(32)], 1, "x") for i in range(150)]
    rows += [(200 + i, rows[3][1], 1, "x") for i in range(40)]  # a hot vector: ties
    rows += [(300, None, 1, "x"), (301, [], 1, "x"), (302, [1.0, None], 1, "x"), (303, [float("nan")] * 32, 1, "x")]
    rows += [(304, [float("inf")] * 32, 1, "x"), (None, [0.5] * 32, 1, "x"), (305, [0.5, 0.25], 1, "x"), (306, [2.5, -0.25], 1, "x"), (307, [0.0] * 32, 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    pairs = [(r[0], r[1]) for r in spark.createDataFrame(rows, SCHEMA).select("vec_id", "embedding").collect()]
    for k in (1, 20, 500):
        got = segment_topk.top_k(df.where("vec_id % 3 = 0"), df, k).select("query_id", "rank", "vec_id", "score").collect()
        asked = [p for p in pairs if p[0] is not None and p[0] % 3 == 0]
        assert sorted(map(tuple, got)) == _plain(asked, pairs, k)


@pytest.mark.parametrize("queries, base", [(128, 1024), (7, 3)])
def test_bounds_prune_and_keep_ties(monkeypatch, queries, base):
    import numpy as np

    monkeypatch.setattr(segment_topk, "_TILE_QUERIES", queries)
    monkeypatch.setattr(segment_topk, "_TILE_BASE", base)
    rng = np.random.default_rng(1)
    centre = rng.integers(-30, 30, (20, 64)).repeat(100, axis=0)
    comps = (centre + rng.integers(-2, 3, centre.shape)).astype("<i2")
    ids = np.arange(2000, dtype="<i8")
    side = segment_topk._Side(ids.tobytes(), comps.tobytes(), "<i2", 64)
    asked = segment_topk._Side(ids[:50].tobytes(), comps[:50].tobytes(), "<i2", 64)
    first = segment_topk._Best(asked, 5)
    some = np.arange(0, 2000, 7)
    segment_topk._search(first, segment_topk._Side(ids[some].tobytes(), comps[some].tobytes(), "<i2", 64), True)
    best = segment_topk._Best(asked, 5, first.bar)
    segment_topk._search(best, side, True)
    assert best.pairs == 50 * 2000 and best.survivors < 0.15 * best.pairs
    scores = comps[:50].astype(int) @ comps.T.astype(int)
    for q in range(50):
        want = sorted((-s, i) for i, s in enumerate(scores[q]) if i != q)[:5]
        assert [(-s, i) for s, i in zip(best.score[best.row == q], best.id[best.row == q], strict=True)] == want


@pytest.mark.parametrize("most, kind", [(20, "f4"), (3000, "f8"), (1 << 20, "f8"), (1 << 26, "i8")])
def test_products_in_the_smallest_exact_type(monkeypatch, most, kind):
    """Bounds are rounded so that no pair is lost, ties keep their order, and a tile ranks its own rows only."""
    import numpy as np

    monkeypatch.setattr(segment_topk, "_TILE_QUERIES", 16)
    monkeypatch.setattr(segment_topk, "_TILE_BASE", 90)
    rng, sorted_rows = np.random.default_rng(5), []
    rank = segment_topk.ranked
    monkeypatch.setattr(segment_topk, "ranked", lambda row, *rest: sorted_rows.append(len(set(row.tolist()))) or rank(row, *rest))
    comps = rng.integers(-most, most, (30, 64)).repeat(20, axis=0) + rng.integers(-2, 3, (600, 64))
    comps[::50] = comps[7]  # copies: ties
    comps[5], comps[11] = 0, most
    ids = rng.permutation(600).astype("<i8") - 100
    ids[:4] = ids[4]  # one id on rows of its own
    side = lambda rows: segment_topk._Side(ids[rows].tobytes(), comps[rows].astype("<i8").tobytes(), "<i8", 64)
    whole = np.arange(600)
    asked = whole[:100]
    best = segment_topk._Best(side(asked), 5)
    for at in range(0, 600, 250):
        segment_topk._search(best, side(whole[at:at + 250]), True)
    scores = [[sum(x * y for x, y in zip(comps[i].tolist(), comps[j].tolist())) for j in range(600)] for i in range(100)]
    for i in range(100):
        want = sorted((-scores[i][j], ids[j]) for j in range(600) if ids[j] != ids[i])[:5]
        assert [(-s, n) for s, n in zip(best.score[best.row == i], best.id[best.row == i], strict=True)] == want
    assert [*best.q._kinds] == [np.dtype(kind).type] and max(sorted_rows, default=0) <= 16


def test_large_components_stay_exact(spark):
    rows = [(0, [2.0**30, 1.0]), (1, [2.0**30, 2.0]), (2, [2.0**30, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = segment_topk.top_k(df, df, 1, scale=1.0).orderBy("query_id").collect()
    assert [(r.query_id, r.vec_id, r.score) for r in got] == [(0, 2, 2**60 + 3), (1, 2, 2**60 + 6), (2, 1, 2**60 + 6)]


def test_sample_is_picked_by_the_tasks_of_the_scan(spark):
    """By the hash of the id before vectors are looked at; odd rows and repeated ids as in the whole."""
    from pyspark.sql import functions as F

    rows = [(i // 2, [float(i), 1.0], 1, "x") for i in range(30000)] + [(None, [1.0], 1, "x"), (7, None, 1, "x"), (8, [float("nan")], 1, "x")]
    base = spark.createDataFrame(rows, SCHEMA).repartition(4)
    sample = segment_topk._sample(base, 30000, "vec_id", "embedding", 64.0)
    valid = segment_topk.valid_vectors(base, "vec_id", "embedding", 64.0)
    want = valid.where(F.pmod(F.xxhash64("id", F.lit(9)), F.lit(30000 // segment_topk.SAMPLE_ROWS)) == 0)
    plain = lambda df: sorted((r.id, r.vector) for r in df.collect())
    assert plain(sample) == plain(want) and 0 < sample.count() < 2 * segment_topk.SAMPLE_ROWS
    plan = sample._jdf.queryExecution().sparkPlan().toString()
    assert sample.rdd.getNumPartitions() == 1 and "Coalesce" not in plan
    assert plan.index("xxhash64") < plan.index("forall")


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([(1, [1.0], 1, "x")], SCHEMA)
    assert segment_topk.top_k(none, one).count() == segment_topk.top_k(one, none).count() == 0
    assert segment_topk.top_k(one, one).count() == 0


def test_query_reads_all_rows(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = op10_exact_topk(spark, sf).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == _plain([r for r in rows if r[0] % 20 == 0], rows, 20)
