"""Neighbour lists kept up to date when base rows come or go.

A stored list of k places is exact up to its last one. Added rows are searched by themselves and
merged with the stored lists, so only they are read. Of a list that loses places, what is left is
still exact up to the old last place: where stored and added rows fill k places up to there, the
list is settled. Only the other queries are searched anew, over the base as it is now.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exactnn.operators.joins import BROADCAST_BYTES, keyed_filter
from exactnn.operators.knn import knn_join, knn_partials
from exactnn.operators.ranking import RESULT_COLUMNS, merge_topk
from exactnn.session import materialize


def update_knn(
    stored: DataFrame, query: DataFrame, k: int, added: DataFrame | None = None, removed: DataFrame | None = None,
    base: DataFrame | None = None, metric: str = "sqeuclidean", *, query_id: str = "query_id", base_id: str = "base_id",
    vector: str = "embedding", decimals: int | None = None, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The lists (query_id, rank, base_id, distance) after a change of the base, as a full search gives them.

    ``stored``: complete lists of the base before, made with the same k, metric and decimals.
    ``added``: new base rows, whose ids were not there. ``removed``: the ids (column ``base_id``) that
    went, each once; ids that the base did not have change nothing. ``base``: the base after the
    change; it is read only if a query is not settled by what is known, and has to be given where
    rows went. Of ``query``, all queries are given, also those whose lists were empty.
    """
    names = {"query_id": query_id, "vector": vector, "base_id": base_id, "decimals": decimals}
    lists = stored.select(*RESULT_COLUMNS)
    reach = lists.groupBy("query_id").agg(
        F.count("*").alias("_n"), F.max(F.struct("distance", "base_id")).alias("_last")
    ).select("query_id", F.when(F.col("_n") >= k, F.col("_last")).alias("_last"))  # a shorter list has the whole base
    left = lists
    if removed is not None:
        gone = removed.select(F.col(base_id).cast("long").alias("base_id"))
        left = keyed_filter(left, gone, "base_id", "query_id", "left_anti", broadcast_bytes)
    candidates = left.select("query_id", "base_id", "distance")
    if added is not None:
        candidates = candidates.unionByName(knn_partials(query, added, k, metric, **names))
    merged = merge_topk(candidates, k)
    if removed is None:
        return merged
    if base is None:
        raise ValueError("rows were removed: the base as it is now is needed for lists that lost places")
    merged = materialize(merged, "merged")
    key = F.struct("distance", "base_id")
    settled = merged.join(reach, "query_id", "left").where(F.col("_last").isNull() | (key <= F.col("_last")))
    settled = settled.groupBy("query_id").agg(F.count("*").alias("_settled"))
    full = reach.where(F.col("_last").isNotNull()).join(settled, "query_id", "left")
    open_ = materialize(full.where(F.coalesce("_settled", F.lit(0)) < k).select("query_id"), "open")
    if not open_.limit(1).count():
        return merged
    again = keyed_filter(
        query.withColumnRenamed(query_id, "query_id"), open_, "query_id", "query_id", "left_semi", broadcast_bytes
    )
    again = materialize(again.select("query_id", F.col(vector).alias("embedding")), "open_queries")
    fresh = knn_join(
        again, base.select(F.col(base_id).alias("base_id"), F.col(vector).alias("embedding")), k, metric, decimals=decimals
    )
    kept = keyed_filter(merged, open_, "query_id", "base_id", "left_anti", broadcast_bytes)
    return kept.unionByName(fresh)


def lost_places(stored: DataFrame, removed: DataFrame, base_id: str = "base_id", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(query_id, lost, first_rank): queries whose lists lose places, how many, and the first of them."""
    gone = removed.select(F.col(base_id).cast("long").alias("base_id"))
    hit = keyed_filter(stored.select(*RESULT_COLUMNS), gone, "base_id", "query_id", "left_semi", broadcast_bytes)
    return hit.groupBy("query_id").agg(F.count("*").alias("lost"), F.min("rank").alias("first_rank"))
