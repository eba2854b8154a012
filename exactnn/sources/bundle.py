"""Export of a ground truth: four vector files, and a bundle of four Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exactnn.functions.vectors import cast_field
from exactnn.operators.ranking import as_arrays
from exactnn.session import materialize
from exactnn.sources.naming import Naming
from exactnn.sources.tables import is_stamped, set_stamp
from exactnn.sources.xvec import count_vectors, exists, write_xvec

# The part names of a bundle.
PARTS = ("train", "test", "neighbors", "distances")

MAX_POSITION = 2**31 - 1


def parts_of(
    result: DataFrame, query: DataFrame, base: DataFrame, vector: str = "embedding"
) -> dict[str, DataFrame]:
    """(idx, vector) for each part. Ids have to be dense positions from 0."""
    lists = materialize(as_arrays(result), "lists")

    def part(df: DataFrame, key: str, values: str) -> DataFrame:
        return df.select(F.col(key).alias("idx"), F.col(values).alias("vector"))

    return {
        "train": part(base, "base_id", vector),
        "test": part(query, "query_id", vector),
        "neighbors": part(lists, "query_id", "neighbors"),
        "distances": part(lists, "query_id", "distances"),
    }


def write_bundle(
    parts: dict[str, DataFrame], path: str, dtype: str | None = None, mode: str = "error"
) -> None:
    """One Parquet table per part; a part that exists is an error unless ``mode`` says otherwise.

    ``dtype`` is the type of the two vector parts, noted with its encoding in the field metadata.
    """
    for name in PARTS:
        df = parts[name]
        if dtype and name in ("train", "test"):
            df = df.select("idx", cast_field("vector", dtype, "vector"))
        df.write.mode(mode).parquet(f"{path}/{name}")


def read_bundle(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in PARTS}


def bundle_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(part, row_count, dim) of every part of a bundle."""
    sizes = [
        df.agg(
            F.lit(name).alias("part"),
            F.count("*").alias("row_count"),
            F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("dim"),
        )
        for name, df in read_bundle(spark, path).items()
    ]
    out = sizes[0]
    for more in sizes[1:]:
        out = out.unionByName(more)
    return out


def bundle_types(spark: SparkSession, path: str) -> DataFrame:
    """(part, element, dtype, encoding): the stored element type of each part, and what its field notes."""
    rows = []
    for name, df in read_bundle(spark, path).items():
        field = df.schema["vector"]
        noted = field.metadata or {}
        rows.append((name, field.dataType.elementType.simpleString(), noted.get("dtype"), noted.get("encoding")))
    return spark.createDataFrame(rows, "part string, element string, dtype string, encoding string")


def check_positions(base_rows: int) -> None:
    """Raise for a base whose positions an ivec cannot hold."""
    if base_rows > MAX_POSITION:
        raise ValueError("an ivec holds 32-bit positions; the base has too many rows")


def export(
    spark: SparkSession,
    names: Naming,
    result: DataFrame,
    query: DataFrame,
    base: DataFrame,
    base_rows: int,
    bundle: bool = True,
    single_file: bool = False,
    stamp: str = "",
) -> DataFrame:
    """Write all outputs of a ground truth. Returns (part, row_count, dim).

    An output that was finished from what ``stamp`` says is kept, any other is written anew.
    """
    check_positions(base_rows)
    parts = parts_of(result, query, base)
    files = {
        "test": (names.query_vectors, "fvec"),
        "train": (names.base_vectors, "fvec"),
        "neighbors": (names.indices, "ivec"),
        "distances": (names.distances, "fvec"),
    }
    manifest = None
    for name, (path, kind) in files.items():
        if not (exists(path) and is_stamped(spark, path, stamp)):
            write_xvec(parts[name], path, kind, single_file=single_file)
            set_stamp(spark, path, stamp)
        size = count_vectors(spark, path, kind).select(F.lit(name).alias("part"), "row_count", "dim")
        manifest = size if manifest is None else manifest.unionByName(size)
    if bundle and not is_stamped(spark, names.bundle, stamp):
        write_bundle(parts, names.bundle, names.dtype, mode="overwrite")
        set_stamp(spark, names.bundle, stamp)
    return manifest
