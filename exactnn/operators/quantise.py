"""Quantised vectors: calibration, scalar and bit quantisation, and neighbours by differing bits.

Scalar types spread each component's calibrated range over 256 steps. Bit types keep the sign of
each component, eight to a value, the first one highest, so that a vector has an eighth of the
values. Calibration is one aggregation of mergeable sketches: nothing but a row for each component
is moved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exactnn.functions.vectors import VECTOR_DTYPES
from exactnn.operators.knn import (
    LIST_SCHEMA,
    RESIDENT_BYTES,
    RESULT_SCHEMA,
    TILES_PER_FILE,
    Pack,
    measure_queries,
    sweep,
)
from exactnn.operators.topk import (
    BlockTopK,
    drop_surplus_copies,
    kth_bound,
    least_of_groups,
    merge_lists,
    reached,
)
from exactnn.session import scratch_path

#: Values of a scalar type, and what is taken off for the signed one (fixed values).
STEPS, SIGNED_SHIFT = 255, 128
BITS = 8
#: Packed queries of a tile, pairs that are ranked at once, and words of pairs that are compared at once.
TILE_QUERIES, PAIRS, XORS = 2048, 1 << 19, 1 << 16
WORD_BITS = 64


def calibrate(df: DataFrame, vector: str = "embedding", tail: float = 0.0, accuracy: int = 10_000) -> DataFrame:
    """(pos, low, high): each component's range, without a share of ``tail`` on either side.

    Without a tail these are minimum and maximum. Otherwise they are quantiles of a sketch whose
    rank error is one in ``accuracy``. Null vectors and components take no part.
    """
    parts = df.select(F.posexplode(vector).alias("pos", "x")).where("x is not null")
    if tail:
        ends = F.percentile_approx("x", [tail, 1 - tail], accuracy)
        found = parts.groupBy("pos").agg(ends.alias("ends"))
        return found.select("pos", F.col("ends")[0].cast("double").alias("low"), F.col("ends")[1].cast("double").alias("high"))
    return parts.groupBy("pos").agg(F.min("x").cast("double").alias("low"), F.max("x").cast("double").alias("high"))


def _doubles(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def scalar_quantised(v: Column | str, ranges: DataFrame, dtype: str = "int8") -> Column:
    """``v`` in 256 steps of the calibrated ranges, clipped: 0..255, or less 128 for int8.

    The ranges, two numbers a component, become part of the expression. A component of one value
    only is step 0; the ranges have to have every component.
    """
    if dtype not in ("int8", "uint8"):
        raise ValueError("scalar types are int8 and uint8")
    rows = ranges.orderBy("pos").collect()
    if [r.pos for r in rows] != list(range(len(rows))):
        raise ValueError("a component has no range")
    shift = SIGNED_SHIFT if dtype == "int8" else 0
    low, step = _doubles([r.low for r in rows]), _doubles([(r.high - r.low) / STEPS for r in rows])
    values = F.col(v) if isinstance(v, str) else v
    away = F.zip_with(values.cast("array<double>"), low, lambda x, a: x - a)
    steps = F.zip_with(away, step, lambda x, s: F.when(s > 0, F.floor(x / s)).otherwise(F.lit(0)))
    clipped = F.transform(steps, lambda x: F.greatest(F.lit(0), F.least(F.lit(STEPS), x)) - shift)
    fits = F.size(values) == len(rows)
    return F.when(fits, clipped.cast(f"array<{VECTOR_DTYPES[dtype][0]}>"))


def bit_quantised(v: Column | str, dtype: str = "ubinary") -> Column:
    """Signs of ``v``, a bit each (1 where positive), eight to a value: 0..255, or less 128 for binary.

    The number of components has to be a multiple of eight; else the vector becomes null.
    """
    if dtype not in ("binary", "ubinary"):
        raise ValueError("bit types are binary and ubinary")
    shift = SIGNED_SHIFT if dtype == "binary" else 0
    values = F.col(v) if isinstance(v, str) else v
    whole = (F.size(values) > 0) & (F.size(values) % BITS == 0)
    starts = F.sequence(F.lit(1), F.size(values) - BITS + 1, F.lit(BITS))
    packed = F.transform(
        starts,
        lambda at: F.aggregate(F.slice(values, at, BITS), F.lit(0), lambda acc, x: acc * 2 + F.when(x > 0, 1).otherwise(0)) - shift,
    )
    return F.when(whole, packed.cast(f"array<{VECTOR_DTYPES[dtype][0]}>"))


def packed_words(column: pa.Array, size: int) -> np.ndarray:
    """A column of packed vectors of ``size`` values, signed or not, as rows of 64-bit words."""
    flat = column.flatten()
    if column.null_count or flat.null_count or len(flat) != len(column) * size:
        raise ValueError(f"every packed vector needs {size} non-null values")
    values = flat.to_numpy(zero_copy_only=False).astype(np.int64)
    rows = (values & 255).astype(np.uint8).reshape(-1, size)
    out = np.zeros((len(rows), -(-size // 8) * 8), np.uint8)
    out[:, :size] = rows
    return out.view(np.uint64)


def differing_bits(queries: np.ndarray, base: np.ndarray) -> np.ndarray:
    """For each query and base row of words the number of differing bits, in the smallest type that holds it."""
    bits = np.zeros((len(queries), len(base)), np.min_scalar_type(WORD_BITS * base.shape[1]))
    step = max(1, XORS // max(1, len(base)))
    for at in range(0, len(queries), step):
        for word in range(base.shape[1]):
            bits[at:at + step] += np.bitwise_count(queries[at:at + step, word][:, None] ^ base[:, word])
    return bits


class HammingTopK(BlockTopK):
    """Running top k by differing bits; vectors are rows of words."""

    def __init__(self, query_ids, queries, k, metric="hamming", decimals=None, bar=None):
        self.decimals, self.metric, self.k = 0, metric, k  # distances are whole
        self.query_ids, self.queries = query_ids.copy(), queries.copy()
        self.bar = np.full(len(query_ids), np.inf) if bar is None else bar.copy()
        self.products = 0
        self.dist = np.full((len(query_ids), k), np.inf)
        self.ids = np.full((len(query_ids), k), np.iinfo(np.int64).max, dtype=np.int64)
        self.waiting, self.waiting_rows = [], 0

    def offer(self, base_ids, base, some=None):
        places = np.arange(len(self.query_ids)) if some is None else some
        self.products += len(places) * len(base)
        step = max(1, PAIRS // max(1, len(base)))
        for at in range(0, len(places), step):
            tile = places[at:at + step]
            bits = differing_bits(self.queries[tile], base)
            least = least_of_groups(bits)
            worst = np.minimum(self.dist[tile, -1], self.bar[tile])
            open_ = np.isinf(worst)
            if open_.any() and len(base) > self.k:
                worst[open_] = kth_bound(bits, least, self.k, open_)
            most = np.minimum(worst, WORD_BITS * base.shape[1]).astype(bits.dtype)
            rows, cols = reached(bits, least, most)
            if len(rows):
                self._admit(tile[rows], base_ids[cols], bits[rows, cols].astype(np.float64))


def _bit_packs(size: int, k: int):
    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[Pack]:
        for batch in batches:
            ids, words = batch.column(0).to_numpy(), packed_words(batch.column(1), size)
            for at in range(0, len(ids), TILE_QUERIES):
                # equal words are equal floats of the same bits, but for those that are no number
                _, first = np.unique(words[at:at + TILE_QUERIES], axis=0, return_inverse=True)
                kept, _ = drop_surplus_copies(ids[at:at + TILE_QUERIES], first.reshape(-1, 1).astype(np.float32), k)
                own = np.isin(ids[at:at + TILE_QUERIES], kept)
                yield Pack(ids[at:at + TILE_QUERIES][own].copy(), words[at:at + TILE_QUERIES][own])

    return packs


def knn_hamming(
    query: DataFrame, base: DataFrame, k: int = 100, query_id: str = "query_id", base_id: str = "base_id",
    vector: str = "embedding", base_tasks: int | None = None, resident: int = RESIDENT_BYTES,
) -> DataFrame:
    """k nearest packed base vectors of every packed query: (query_id, rank, base_id, distance).

    The distance is the number of differing bits; ties rank by id. The base is read once, as in the
    grid form of ``knn_join``. Both ids are unique integers.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = query.sparkSession
    queries = query.select(F.col(query_id).cast("long").alias("id"), F.col(vector).alias("vec"))
    rows = base.select(F.col(base_id).cast("long").alias("id"), F.col(vector).alias("vec"))
    size = measure_queries(queries, "vec")
    if not size.rows:
        return spark.createDataFrame([], RESULT_SCHEMA)
    values, words = size.dim, -(-size.dim // 8)

    def pack(table: pa.Table) -> pa.Table:
        column = table.column("vec").combine_chunks()
        return pa.table({
            "qblock": table.column("qblock").slice(0, 1),
            "qids": pa.array([table.column("id").to_numpy().tobytes()], pa.binary()),
            "qvecs": pa.array([packed_words(column, values).tobytes()], pa.binary()),
        })

    blocks = -(-size.rows // TILE_QUERIES)
    tiles = scratch_path(spark, "tiles")
    numbered = queries.withColumn("qblock", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    numbered.groupBy("qblock").applyInArrow(pack, "qblock int, qids binary, qvecs binary").write.option("maxRecordsPerFile", TILES_PER_FILE).parquet(tiles)
    lists = (rows.coalesce(base_tasks) if base_tasks else rows).mapInArrow(
        sweep(_bit_packs(values, k), words, k, "hamming", None, tiles, resident=resident, kernel=HammingTopK, dtype=np.uint64), LIST_SCHEMA
    )
    together = lists.repartition("query_id").sortWithinPartitions("query_id")
    return together.mapInArrow(merge_lists(k, 0), RESULT_SCHEMA)
