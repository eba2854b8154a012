"""Joins whose broadcasts are size-checked and whose hot keys are split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exactnn.session import MIB

BROADCAST_BYTES = 64 * MIB
HOT_ROWS = 1_000_000


def null_safe_key(c: Column | str) -> Column:
    """A non-null text key under which null equals null and nothing else."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def key_bytes(keys: DataFrame, key: str) -> int:
    """Measured size of a key column."""
    total = keys.agg(F.sum(F.length(F.col(key).cast("string")) * 4 + 16).alias("b")).first().b
    return int(total or 0)


def split_join(
    left: DataFrame, right: DataFrame, key: str, spread_on: str, how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Shuffle join on ``key`` with the hot keys of ``left`` split over several tasks.

    A key with more than ``hot_rows`` rows on the left is cut into slices by the hash of
    ``spread_on``; only the right rows of those keys are repeated, once per slice. The table of
    hot keys has at most ``|left| / hot_rows`` rows, which bounds its broadcast.
    ``right`` holds few rows per key. ``how`` is inner, left_semi, left_anti or left.
    """
    counts = left.groupBy(key).agg(F.count("*").alias("n"))
    hot = counts.where(F.col("n") > hot_rows).select(
        key, F.ceil(F.col("n") / hot_rows).cast("int").alias("_slices")
    )
    slices = F.coalesce("_slices", F.lit(1))
    cut = left.join(F.broadcast(hot), key, "left").withColumn(
        "_slice", F.pmod(F.xxhash64(spread_on), slices).cast("int")
    )
    repeated = right.join(F.broadcast(hot), key, "left").withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), slices - 1))
    )
    joined = cut.drop("_slices").join(repeated.drop("_slices"), [key, "_slice"], how)
    return joined.drop("_slice")


def keyed_filter(
    left: DataFrame, keys: DataFrame, key: str, spread_on: str, how: str = "left_semi",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """left_semi / left_anti join with a distinct, non-null key list.

    The keys are measured first: a list within ``broadcast_bytes`` is broadcast and ``left`` is
    not shuffled; a longer one goes through :func:`split_join`.
    """
    if key_bytes(keys, key) <= broadcast_bytes:
        return left.join(F.broadcast(keys), key, how)
    return split_join(left, keys, key, spread_on, how)
