"""Merging and reshaping of top-k lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

RESULT_COLUMNS = ("query_id", "rank", "base_id", "distance")


def merge_topk(candidates: DataFrame, k: int) -> DataFrame:
    """Global top k from per-block lists (query_id, base_id, distance), with ranks from 0.

    The limit on ``row_number`` becomes a group limit before and after the exchange, so at most
    k rows per query and map task are shuffled.
    """
    by_distance = Window.partitionBy("query_id").orderBy("distance", "base_id")
    place = candidates.withColumn("place", F.row_number().over(by_distance))
    ranked = place.where(F.col("place") <= k).withColumn("rank", F.col("place") - 1)
    return ranked.select(*RESULT_COLUMNS)


def as_arrays(result: DataFrame) -> DataFrame:
    """One row per query: ``neighbors`` and ``distances`` in rank order.

    A query has at most k rows, so the collected list is bounded by k.
    """
    ordered = F.array_sort(F.collect_list(F.struct("rank", "base_id", "distance")))
    return (
        result.groupBy("query_id")
        .agg(ordered.alias("hits"))
        .select(
            "query_id",
            F.col("hits.base_id").alias("neighbors"),
            F.col("hits.distance").alias("distances"),
        )
    )


def as_wide(arrays: DataFrame, values: str, k: int) -> DataFrame:
    """Array view -> the positional form with columns ``"0"`` .. ``"k-1"``."""
    return arrays.select("query_id", *[F.get(values, F.lit(i)).alias(str(i)) for i in range(k)])


def from_wide_pair(indices: DataFrame, distances: DataFrame, key: str = "query_id") -> DataFrame:
    """Two positional tables -> long candidates (query_id, pos, base_id, distance).

    ``RowNum``, a row id of older files, is ignored. The k value columns are taken by position,
    whatever their names.
    """
    def long(df: DataFrame, value: str, cast: T.DataType) -> DataFrame:
        names = [c for c in df.columns if c not in (key, "RowNum")]
        packed = F.array(*[F.col(f"`{c}`").cast(cast) for c in names])
        return df.select(key, F.posexplode(packed).alias("pos", value))

    ids = long(indices, "base_id", T.LongType())
    gaps = long(distances, "distance", T.DoubleType())
    return ids.join(gaps, [key, "pos"]).withColumnRenamed(key, "query_id")
