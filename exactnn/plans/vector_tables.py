"""Jobs on existing vector tables: split, sort, page, and report duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exactnn.functions.vectors import to_wide
from exactnn.operators.dedup import duplicate_summary
from exactnn.operators.ids import pages
from exactnn.operators.quality import dimensions
from exactnn.session import range_partitioned
from exactnn.sources.bundle import read_bundle
from exactnn.sources.tables import write_vectors


def split_table(
    spark: SparkSession,
    source: str,
    target: str,
    vector: str = "embedding",
    keep: Sequence[str] | None = None,
    mode: str = "error",
) -> DataFrame:
    """Copy a list-valued vector table with one column per dimension."""
    df = spark.read.parquet(source)
    size = dimensions(df, vector).first()
    if size.min_dim != size.max_dim:
        raise ValueError(f"vectors have between {size.min_dim} and {size.max_dim} components")
    write_vectors(to_wide(df, size.max_dim, vector, keep=keep), target, mode=mode)
    return spark.read.parquet(target)


def sort_table(
    spark: SparkSession, source: str, target: str, keys: Sequence[str], mode: str = "error"
) -> DataFrame:
    # global order: part files in name order follow the keys
    write_vectors(range_partitioned(spark.read.parquet(source), keys), target, mode=mode)
    return spark.read.parquet(target)


def paged_table(
    spark: SparkSession, source: str, target: str, order: Sequence[str], rows: int = 1_000_000
) -> DataFrame:
    """Copy a table in pages of ``rows`` rows, one folder per page."""
    paged = pages(spark.read.parquet(source), order, rows)
    paged.write.mode("error").partitionBy("page").parquet(target)
    return spark.read.parquet(target)


def duplicate_report(spark: SparkSession, bundle: str) -> DataFrame:
    """Totals, distinct and repeated vectors of the train and test parts of a bundle."""
    parts = read_bundle(spark, bundle)
    reports = [
        duplicate_summary(parts[name], "idx", "vector").select(F.lit(name).alias("part"), "*")
        for name in ("train", "test")
    ]
    return reports[0].unionByName(reports[1])
