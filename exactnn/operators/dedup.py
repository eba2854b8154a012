"""Duplicate vectors: report and order-preserving removal.

Whole vectors are only shuffled where their 64-bit hash occurs more than once. The hash decides
nothing by itself: vectors with the same hash are grouped by their components. Groups are
pre-aggregated before the exchange, so any number of copies leaves a map task as one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exactnn.operators.joins import keyed_filter
from exactnn.session import materialize


def _suspects(df: DataFrame, vector: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with its hash, and the hashes that occur more than once."""
    hashed = df.withColumn("_hash", F.xxhash64(vector))
    repeated = hashed.groupBy("_hash").agg(F.count("*").alias("_n")).where("_n > 1").select("_hash")
    # written once: it is measured, then joined
    return hashed, materialize(repeated, "repeated_hashes")


def duplicate_vectors(df: DataFrame, vector_id: str, vector: str = "embedding") -> DataFrame:
    """Distinct vectors that occur more than once: (first_id, copies, embedding)."""
    hashed, repeated = _suspects(df.select(vector_id, vector), vector)
    suspects = keyed_filter(hashed, repeated, "_hash", vector_id)
    return (
        suspects.groupBy(vector)
        .agg(F.min(vector_id).alias("first_id"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("first_id", "copies", vector)
    )


def duplicate_summary(df: DataFrame, vector_id: str, vector: str = "embedding") -> DataFrame:
    """One row: total rows, distinct vectors, distinct vectors that have copies."""
    none = F.lit(0).cast("long")
    total = df.agg(
        F.count("*").alias("rows"), none.alias("surplus"), none.alias("repeated")
    )
    found = duplicate_vectors(df, vector_id, vector).agg(
        none.alias("rows"),
        F.coalesce(F.sum(F.col("copies") - 1), none).alias("surplus"),
        F.count("*").alias("repeated"),
    )
    both = total.unionByName(found)
    return both.agg(
        F.sum("rows").alias("total_rows"),
        (F.sum("rows") - F.sum("surplus")).alias("unique_rows"),
        F.sum("repeated").alias("duplicate_rows"),
    )


def drop_duplicate_vectors(df: DataFrame, vector_id: str, vector: str = "embedding") -> DataFrame:
    """Keep, of equal vectors, the row with the smallest id; all columns survive."""
    hashed, repeated = _suspects(df, vector)
    single = keyed_filter(hashed, repeated, "_hash", vector_id, "left_anti")
    suspects = keyed_filter(hashed, repeated, "_hash", vector_id)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    kept = suspects.groupBy(vector).agg(F.min_by(row, vector_id).alias("_row")).select("_row.*")
    return single.select(*df.columns).unionByName(kept)
