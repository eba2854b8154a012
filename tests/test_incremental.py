"""Updated lists are those of a full search, and only what changed is read."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_knn import as_set, brute, frame, knn_join, unit

from exactnn.operators.incremental import lost_places, update_knn

METRICS = ("sqeuclidean", "cosine", "inner")


@pytest.fixture(scope="module")
def sides():
    rng = np.random.default_rng(11)
    q, b = unit(rng, 60, 12), unit(rng, 500, 12)
    b[rng.permutation(500)[:80]] = b[3]
    return q, b


def _counted(spark, df):
    read = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), read


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("limit", (1 << 26, 0))
def test_added_and_removed(spark, sides, metric, limit):
    q, b = sides
    query, base = frame(spark, range(60), q, "query_id"), frame(spark, range(500), b, "base_id")
    stored = knn_join(query, base.where("base_id < 400"), 8, metric)
    gone = base.where("base_id % 7 = 0 and base_id < 400").select("base_id").unionByName(spark.range(9000, 9005).toDF("base_id"))
    now = base.where("base_id >= 400 or base_id % 7 <> 0")
    found = update_knn(stored, query, 8, base.where("base_id >= 400"), gone, now, metric, decimals=6, broadcast_bytes=limit)
    keep = np.array([i for i in range(500) if i >= 400 or i % 7])
    assert as_set(found) == brute(q, b[keep], 8, metric, bids=keep)


def test_only_the_change_is_read(spark, sides):
    q, b = sides
    query, base = frame(spark, range(60), q, "query_id"), frame(spark, range(500), b, "base_id")
    stored = knn_join(query, base.where("base_id < 400"), 8)
    added, read = _counted(spark, base.where("base_id >= 400"))
    assert as_set(update_knn(stored, query, 8, added, decimals=6)) == brute(q, b, 8, "sqeuclidean")
    assert read.value == 100
    # rows that are in no list leave every list as it is, and the base unread
    listed = {r.base_id for r in stored.collect()}
    far = spark.createDataFrame([(i,) for i in range(400) if i not in listed], "base_id long")
    now, read = _counted(spark, base.where("base_id < 400"))
    assert as_set(update_knn(stored, query, 8, removed=far, base=now, decimals=6)) == as_set(stored)
    assert read.value == 0


def test_only_open_queries_are_searched(spark, sides):
    """The nearest row of one query goes: the others keep their lists."""
    q, b = sides
    query, base = frame(spark, range(60), q, "query_id"), frame(spark, range(500), b, "base_id")
    stored = knn_join(query, base, 8)
    counts = stored.groupBy("base_id").agg(F.count("*").alias("n")).where("n = 1").join(stored, "base_id").where("rank = 0")
    row = counts.first()
    gone = spark.createDataFrame([(row.base_id,)], "base_id long")
    assert [tuple(r) for r in lost_places(stored, gone).collect()] == [(row.query_id, 1, 0)]
    keep = np.array([i for i in range(500) if i != row.base_id])
    found = update_knn(stored, query, 8, removed=gone, base=base.where(F.col("base_id") != row.base_id), decimals=6)
    assert as_set(found) == brute(q, b[keep], 8, "sqeuclidean", bids=keep)
    with pytest.raises(ValueError):
        update_knn(stored, query, 8, removed=gone)


def test_short_lists(spark, sides):
    """Lists of a base of fewer than k rows, which shrinks and grows."""
    q, b = sides
    query, base = frame(spark, range(60), q, "query_id"), frame(spark, range(500), b, "base_id")
    stored = knn_join(query, base.where("base_id < 5"), 8)
    gone = spark.createDataFrame([(1,), (2,)], "base_id long")
    now = base.where("base_id in (0, 3, 4, 10, 11)")
    found = update_knn(stored, query, 8, base.where("base_id in (10, 11)"), gone, now, decimals=6)
    keep = np.array([0, 3, 4, 10, 11])
    assert as_set(found) == brute(q, b[keep], 8, "sqeuclidean", bids=keep)
