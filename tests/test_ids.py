import random

import pytest
from pyspark.sql import functions as F

from exactnn.operators import ids as I


@pytest.fixture(scope="module")
def lines(spark, sf):
    return spark.read.parquet(f"{sf}/orders.parquet").select("o_custkey", "o_orderkey")


ORDER = ["o_custkey", "o_orderkey"]


def test_dense_index_is_the_sorted_position(lines):
    got = [tuple(r) for r in I.dense_index(lines.repartition(7), ORDER).orderBy("idx").collect()]
    keys = sorted(tuple(r) for r in lines.collect())
    assert got == [(*key, i) for i, key in enumerate(keys)]


@pytest.mark.parametrize("n", (1, 10_000, 10_001, 12_345, 10**7))
def test_first_n_small_and_large(lines, n):
    keys = sorted(tuple(r) for r in lines.collect())
    assert sorted(tuple(r) for r in I.first_n(lines, ORDER, n).collect()) == keys[:n]


def test_large_first_n_is_a_filter_on_the_scan(lines):
    plan = I.first_n(lines, ORDER, 11_000)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "PushedFilters: [Or(" in plan


def test_weighted_boundary(spark):
    df = spark.createDataFrame([(i, i % 4) for i in range(100)], "k long, w int")
    running = 0
    for i in range(100):
        running += i % 4
        if running >= 77:
            break
    assert I.position_boundary(df, ["k"], 77, "w").k == i
    assert I.position_boundary(df, ["k"], 151, "w") is None


def test_pages(lines):
    total = lines.count()
    counts = I.pages(lines, ORDER, 7000).groupBy("page").count().orderBy("page").collect()
    assert [r["count"] for r in counts] == [7000] * (total // 7000) + [total % 7000]
    keys = sorted(tuple(r) for r in lines.collect())
    window = I.page(lines, ORDER, 10_000, 500)
    assert sorted(tuple(r) for r in window.collect()) == keys[10_000:10_500]


def test_order_predicate(spark):
    df = spark.range(60).select((F.col("id") % 3).alias("a"), F.floor(F.col("id") / 3).alias("b"))
    key = spark.createDataFrame([(1, 4)], "a long, b long").first()
    got = {tuple(r) for r in df.where(I.up_to(["a", "b"], key)).collect()}
    assert got == {(a, b) for a in range(3) for b in range(20) if (a, b) <= (1, 4)}


def test_small_inputs_are_spread_and_large_ones_left(spark, sf):
    from exactnn.session import input_bytes, spread

    df = spark.read.parquet(f"{sf}/orders.parquet")
    assert 0 < input_bytes(df) < 10**7
    assert "REPARTITION" in spread(df, "o_orderkey")._jdf.queryExecution().toString()
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "10k")
    try:
        assert spread(df, "o_orderkey") is df
    finally:
        spark.conf.set(key, before)


def test_first_n_of_a_source_of_unknown_size(spark):
    df = spark.createDataFrame([(i * 37 % 100,) for i in range(100)], "k long")
    assert sorted(r.k for r in I.first_n(df, ["k"], 7).collect()) == list(range(7))


def _positions(rows, keys):
    """Rows under ``keys``, nulls first, equal keys in the order of either form."""
    return sorted(rows, key=lambda r: [(r[k] is not None, r[k]) for k in keys])


@pytest.mark.parametrize("low, high", [(0, 1), (0, 7), (0, 50), (5, 9), (11, 40), (39, 60), (90, 95), (0, 0)])
def test_both_forms_give_the_same_rows(spark, monkeypatch, low, high):
    rng = random.Random(high)
    rows = [
        (rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]), rng.choice([0.5, None]), i % 5) for i in range(55)
    ]
    df = spark.createDataFrame(rows + rows[:15], "k long, s string, x double, n int").repartition(4)
    small = I.page(df, ["k", "s"], low, high - low).collect()
    monkeypatch.setattr(I, "TOP_ROWS", 0)
    large = I.page(df, ["k", "s"], low, high - low).collect()
    assert sorted(map(tuple, large), key=repr) == sorted(map(tuple, small), key=repr)
    assert len(large) == max(0, min(high, 70) - low)
    keys = [(r[0], r[1]) for r in _positions([tuple(r) for r in df.collect()], [0, 1])][low:high]
    assert sorted(((r.k, r.s) for r in large), key=repr) == sorted(keys, key=repr)
