"""Vector and neighbour tables in Parquet."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from exactnn.functions.vectors import from_wide, wide_names
from exactnn.operators.ids import first_n
from exactnn.operators.ranking import from_wide_pair


def read_vectors(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    prefix: str = "embedding_",
    vector: str = "embedding",
    n: int | None = None,
    order: Sequence[str] = ("idx",),
    position: str | None = None,
) -> DataFrame:
    """Vector table(s) with the vector as one list column, whichever way they are stored.

    ``columns`` names the metadata columns to keep (all by default). ``position`` adds the
    0-based row position in (file, row) order, for tables whose ids are positions.
    ``n`` keeps the first rows under ``order``.
    """
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*paths)
    if position:
        df = df.withColumn("_file", F.col("_metadata.file_path")).withColumn(
            "_row", F.col("_metadata.row_index")
        )
    if vector not in df.columns and wide_names(df, prefix):
        df = from_wide(df, prefix, vector)
    if columns is not None:
        keep = [*columns, vector, *(["_file", "_row"] if position else [])]
        df = df.select(*keep)
    if position:
        df = _positioned(df, position)
        order = (position,)
    return df if n is None else first_n(df, list(order), n)


def text_and_vector(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """The text column (``question`` before ``text``, where there is one) and the vector."""
    text = next(([name] for name in ("question", "text") if name in df.columns), [])
    return df.select(*text, vector)


def _positioned(df: DataFrame, name: str) -> DataFrame:
    """Row position over all files in path order: rows in earlier files plus row in this one.

    The table of offsets has one row per file; no row of the data is moved.
    """
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy("_file")
        .agg(F.count("*").alias("_n"))
        .select("_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    position = (F.col("_before") + F.col("_row")).alias(name)
    rest = [c for c in df.columns if c not in ("_file", "_row")]
    return df.join(F.broadcast(offsets), "_file").select(*rest, position)


def write_vectors(
    df: DataFrame,
    path: str,
    columns: Sequence[str] | None = None,
    rows_per_file: int | None = None,
    mode: str = "error",
) -> None:
    """Write a table; one that exists is an error unless ``mode`` says otherwise."""
    out = df if columns is None else df.select(*columns)
    writer = out.write.mode(mode)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def stamp_of(**parameters) -> str:
    """What a stored output was made from, as text: parameters, and tables by schema and files."""
    def plain(value):
        if isinstance(value, DataFrame):
            files = hashlib.sha256("\n".join(sorted(value.inputFiles())).encode()).hexdigest()
            return [value.schema.simpleString(), files]
        return repr(value) if not isinstance(value, (str, int, float, type(None))) else value

    return json.dumps({name: plain(v) for name, v in sorted(parameters.items())})


def is_stamped(spark: SparkSession, path: str, stamp: str) -> bool:
    """Whether the output at ``path`` was finished, from what ``stamp`` says."""
    try:
        found = spark.read.schema("stamp string").parquet(f"{path}.stamp").first()
    except AnalysisException:
        return False
    return found is not None and found.stamp == stamp


def set_stamp(spark: SparkSession, path: str, stamp: str) -> None:
    """Note, once the output at ``path`` is finished, what it was made from."""
    one = spark.createDataFrame([(stamp,)], "stamp string").coalesce(1)
    one.write.mode("overwrite").parquet(f"{path}.stamp")


def read_blocks(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """Positional block files ``<kind><number>.parquet`` with ``block_id`` and ``query_id``.

    The query number is the row position inside its file. Files may name their columns differently;
    a row has nulls in the columns of other files.
    """
    options = {"pathGlobFilter": f"{kind}[0-9]*.parquet", "mergeSchema": "true"}
    df = spark.read.options(**options).parquet(folder)
    number = F.regexp_extract(F.col("_metadata.file_name"), rf"^{kind}(\d+)\.parquet$", 1)
    positional = df.withColumn("block_id", number.cast("int")).withColumn(
        "query_id", F.col("_metadata.row_index")
    )
    return positional.drop("RowNum")


def block_count(spark: SparkSession, folder: str, kind: str = "indices") -> int:
    return read_blocks(spark, folder, kind).agg(F.count_distinct("block_id").alias("n")).first().n


def import_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Block files of indices and distances as long candidates (query_id, base_id, distance)."""
    def keyed(kind: str) -> DataFrame:
        df = read_blocks(spark, folder, kind)
        return df.withColumn("_key", F.struct("block_id", "query_id")).drop("block_id", "query_id")

    long = from_wide_pair(keyed("indices"), keyed("distances"), key="_key")
    return long.select(
        F.col("query_id.query_id").alias("query_id"), "base_id", "distance"
    ).where(F.col("base_id").isNotNull())
