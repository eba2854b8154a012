"""Exact k nearest neighbours that leave out blocks of the base which a query cannot reach.

The base is clustered once: each row goes to its nearest centre, and the rows of a centre, in order
of their distance to it, are cut into blocks. A block lies in a shell, between its least and its
greatest distance, so the triangle inequality bounds from below how near any of its rows can be:

* squared L2: the gap between the shell and the query's distance to the centre, squared;
* cosine: the same for vectors of unit length, where the squared distance is twice the cosine one
  (a zero vector is farther than the bound says, which is all that a bound has to promise);
* inner: the product with the centre, and the query's length times the shell's outer radius.

A search first gives each query a bar: its k-th distance in the innermost block of its nearest
centre. In the tasks a query then meets its nearest block first and every other block only while
that block's bound does not lie above the bar. Results are those of the full search, ties included.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exactnn.functions.vectors import METRICS
from exactnn.operators.knn import (
    LIST_SCHEMA,
    RESIDENT_BYTES,
    RESULT_SCHEMA,
    TILES_PER_FILE,
    Pack,
    QuerySize,
    block_rows,
    measure_queries,
    sweep,
)
from exactnn.operators.topk import BlockTopK, drop_surplus_copies, merge_lists, vector_matrix
from exactnn.session import input_bytes, materialize, parallelism, range_partitioned, scratch_path

#: Centres at most: their vectors are in every task.
MAX_CENTRES = 4096
ROWS_PER_BALL = 2048
#: Relative allowance for rounding in a bound.
_SLACK = 1e-9
_BALLS = "centre int, inner double, outer double, row_count int, bids binary, bvecs binary"


@dataclass(frozen=True)
class Balls:
    """A clustered base: ``table`` has one row per block, ``centres`` the (n, dim) centre vectors."""

    table: DataFrame
    centres: np.ndarray
    metric: str
    rows: int

    @property
    def dim(self) -> int:
        return self.centres.shape[1]


def _placed(vectors: np.ndarray, metric: str) -> np.ndarray:
    """Vectors in the space whose distances bound the metric, as float64."""
    wide = vectors.astype(np.float64)
    if metric != "cosine":
        return wide
    norms = np.sqrt(np.einsum("ij,ij->i", wide, wide))[:, None]
    return np.divide(wide, norms, out=np.zeros_like(wide), where=norms > 0)


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = np.einsum("ij,ij->i", points, points)[:, None] + np.einsum("ij,ij->i", centres, centres)
    return np.sqrt(np.maximum(square - 2 * points @ centres.T, 0))


def _nearest(points: np.ndarray, centres: np.ndarray, step: int = 4096) -> np.ndarray:
    found = [_distances(points[a:a + step], centres).argmin(axis=1) for a in range(0, len(points), step)]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _first_centres(rows: DataFrame, n: int, dim: int, metric: str) -> np.ndarray:
    """Vectors of the ids of the least hashes: the same ones whenever a task runs again."""
    some = rows.orderBy(F.xxhash64("id", F.lit(5)), "id").limit(n).select("vec").toArrow()
    return _placed(vector_matrix(some.column("vec"), dim), metric)


def _moved_centres(rows: DataFrame, centres: np.ndarray, metric: str) -> np.ndarray:
    """The means of what is nearest to each centre; one without rows stays. Each task sends its sums."""
    n, dim = centres.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((n, dim)), np.zeros(n, np.int64)
        for batch in batches:
            points = _placed(vector_matrix(batch.column("vec"), dim), metric)
            own = _nearest(points, centres)
            np.add.at(total, own, points)
            count += np.bincount(own, minlength=n)
        met = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met.astype(np.int32)), pa.array(count[met]), pa.array([total[i].tobytes() for i in met], pa.binary())],
            ["centre", "n", "total"],
        )

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(t, np.float64) for t in table.column("total").to_pylist())
        return pa.table({
            "centre": table.column("centre").slice(0, 1), "n": pa.array([sum(table.column("n").to_pylist())], pa.int64()),
            "total": pa.array([total.tobytes()], pa.binary()),
        })

    schema = "centre int, n long, total binary"
    moved = centres.copy()
    for r in rows.select("vec").mapInArrow(sums, schema).groupBy("centre").applyInArrow(added, schema).collect():
        moved[r.centre] = np.frombuffer(r.total, np.float64) / r.n
    return moved


def build_balls(
    base: DataFrame, metric: str = "sqeuclidean", base_id: str = "base_id", vector: str = "embedding",
    centres: int | None = None, rows_per_ball: int = ROWS_PER_BALL, rounds: int = 1,
) -> Balls:
    """Cluster a base for :func:`knn_ball_join` with ``metric``. Ids are unique integers.

    ``centres`` defaults to one for two blocks, at most MAX_CENTRES; only they reach the driver. The
    rows are range-sorted once by (centre, distance), so that a centre of many rows, or of equal
    ones, is dealt to many tasks.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, got {metric!r}")
    rows = base.select(F.col(base_id).cast("long").alias("id"), F.col(vector).alias("vec"))
    size = measure_queries(rows, "vec")
    spark, dim = base.sparkSession, max(1, size.dim)
    if not size.rows:
        return Balls(spark.createDataFrame([], _BALLS), np.zeros((0, dim)), metric, 0)
    wanted = centres or math.ceil(size.rows / (2 * rows_per_ball))
    points = _first_centres(rows, max(1, min(wanted, MAX_CENTRES)), dim, metric)
    for _ in range(rounds):
        points = _moved_centres(rows, points, metric)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _placed(vector_matrix(batch.column("vec"), dim), metric)
            centre = _nearest(own, points)
            away = own - points[centre]
            distance = np.sqrt(np.einsum("ij,ij->i", away, away))
            yield pa.RecordBatch.from_arrays(
                [pa.array(centre.astype(np.int32)), pa.array(distance), batch.column("id"), batch.column("vec")],
                ["centre", "distance", "id", "vec"],
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def close() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            ids, vectors = table.column("id").to_numpy(), vector_matrix(table.column("vec"), dim)
            away = table.column("distance").to_numpy()
            kinds = (pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.binary(), pa.binary())
            values = (table.column("centre")[0].as_py(), away.min(), away.max(), len(ids), ids.tobytes(), vectors.tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, kinds, strict=True)],
                ["centre", "inner", "outer", "row_count", "bids", "bvecs"],
            )

        filled, current = 0, None
        for batch in batches:
            centre = batch.column("centre").to_numpy()
            at = 0
            while at < len(centre):
                if held and (centre[at] != current or filled == rows_per_ball):
                    yield close()
                    held, filled = [], 0
                current = centre[at]
                last = at + int(np.searchsorted(centre[at:], current, "right"))
                last = min(last, at + rows_per_ball - filled)
                held.append(batch.slice(at, last - at))
                filled, at = filled + last - at, last
        if held:
            yield close()

    placed = materialize(rows.mapInArrow(place, "centre int, distance double, id long, vec array<float>"), "placed")
    table = range_partitioned(placed, ["centre", "distance", "id"]).mapInArrow(pack, _BALLS)
    return Balls(materialize(table, "balls"), points, metric, size.rows)


def _bounds(top_vectors: np.ndarray, centre: np.ndarray, inner: np.ndarray, outer: np.ndarray, metric: str) -> np.ndarray:
    """(query, block): distances that no row of the block lies below."""
    points = _placed(top_vectors, metric)
    if metric == "inner":
        reach = np.sqrt(np.einsum("ij,ij->i", points, points))[:, None] * outer
        product = points @ centre.T
        return 1.0 - product - reach - _SLACK * (np.abs(product) + reach) - 4 * np.finfo(float).eps
    away = _distances(points, centre)
    # the difference of squares inside loses half of the digits where the query is nearly the centre
    length = lambda x: np.sqrt(np.einsum("ij,ij->i", x, x))
    blur = 1e-7 * (length(points)[:, None] + length(centre))
    gap = np.maximum(np.maximum(away - outer, inner - away) - blur, 0)
    return (gap * gap if metric == "sqeuclidean" else gap * gap / 2) * (1 - _SLACK)


def _offer_reachable(centres: np.ndarray, metric: str, decimals: int | None):
    step = 0.0 if decimals is None else 10.0**-decimals

    def offer(top: BlockTopK, packs: list[Pack]) -> None:
        number, inner, outer = (np.array(x) for x in zip(*[p.ball for p in packs], strict=True))
        bound = _bounds(top.queries, centres[number], inner, outer, metric)
        nearest = bound.argmin(axis=1)
        for at in np.unique(nearest).tolist():
            own = np.flatnonzero(nearest == at)
            own = own[bound[own, at] <= top.bar[own] + step]
            if len(own):
                top.offer(packs[at].ids, packs[at].vectors, own)
        for at in np.argsort(bound.min(axis=0), kind="stable").tolist():
            own = np.flatnonzero((bound[:, at] <= np.minimum(top.dist[:, -1], top.bar) + step) & (nearest != at))
            if len(own):
                top.offer(packs[at].ids, packs[at].vectors, own)

    return offer


def _ball_packs(dim: int, k: int):
    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[Pack]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["bids"], np.int64)
                kept, own = drop_surplus_copies(ids, np.frombuffer(row["bvecs"], np.float32).reshape(-1, dim), k)
                yield Pack(kept, own, (row["centre"], row["inner"], row["outer"]))

    return packs


def _tiles_with_bars(queries: DataFrame, balls: Balls, size: QuerySize, k: int, decimals: int | None) -> str:
    """Store the queries in tiles, those of one nearest centre together, with a first bar each."""
    centres, metric, dim = balls.centres, balls.metric, balls.dim
    per_block = block_rows(dim)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _nearest(_placed(vector_matrix(batch.column("vec"), dim), metric), centres)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own.astype(np.int32)), batch.column("id"), batch.column("vec")], ["centre", "id", "vec"]
            )

    def pack(table: pa.Table) -> pa.Table:
        return pa.table({
            "centre": table.column("centre").slice(0, 1), "sub": table.column("sub").slice(0, 1),
            "qids": pa.array([table.column("id").to_numpy().tobytes()], pa.binary()),
            "qvecs": pa.array([vector_matrix(table.column("vec"), dim).tobytes()], pa.binary()),
        })

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bars = []
            for row in range(batch.num_rows):
                cell = {c: batch.column(c)[row] for c in batch.schema.names}
                array = lambda c, kind: np.frombuffer(cell[c].as_buffer(), kind)  # noqa: B023, E731
                top = BlockTopK(array("qids", np.int64), array("qvecs", np.float32).reshape(-1, dim), k, metric, decimals)
                if cell["bids"].is_valid:
                    top.offer(array("bids", np.int64), array("bvecs", np.float32).reshape(-1, dim))
                bars.append(top.kth().tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("qids"), batch.column("qvecs"), pa.array(bars, pa.binary())], ["qids", "qvecs", "qbars"]
            )

    assigned = materialize(queries.mapInArrow(assign, "centre int, id long, vec array<float>"), "assigned")
    counts = assigned.groupBy("centre").agg(F.ceil(F.count("*") / per_block).alias("subs"))  # MAX_CENTRES rows
    blocks = assigned.join(F.broadcast(counts), "centre").withColumn("sub", F.pmod(F.xxhash64("id"), "subs").cast("int"))
    blocks = blocks.select("centre", "sub", "id", "vec").groupBy("centre", "sub").applyInArrow(
        pack, "centre int, sub int, qids binary, qvecs binary"
    )
    inmost = balls.table.groupBy("centre").agg(F.min("inner").alias("inner"))
    inmost = balls.table.join(F.broadcast(inmost), ["centre", "inner"]).dropDuplicates(["centre"])
    met = blocks.join(inmost.select("centre", "bids", "bvecs"), "centre", "left").drop("centre", "sub")
    path = scratch_path(queries.sparkSession, "tiles")
    met.mapInArrow(first, "qids binary, qvecs binary, qbars binary").write.option("maxRecordsPerFile", TILES_PER_FILE).parquet(path)
    return path


def knn_ball_join(
    query: DataFrame, balls: Balls, k: int = 100, query_id: str = "query_id", vector: str = "embedding",
    decimals: int | None = None, resident: int = RESIDENT_BYTES, count=None,
) -> DataFrame:
    """k nearest base rows of every query: (query_id, rank, base_id, distance), as ``knn_join`` has it.

    The clustered base is read once, whatever the number of queries. ``count``, an accumulator,
    takes the number of pairs that were scored.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = query.sparkSession
    queries = query.select(F.col(query_id).cast("long").alias("id"), F.col(vector).alias("vec"))
    size = measure_queries(queries, "vec")
    if not size.rows or not balls.rows:
        return spark.createDataFrame([], RESULT_SCHEMA)
    if size.dim != balls.dim:
        raise ValueError(f"queries have {size.dim} components, the base has {balls.dim}")
    tiles = _tiles_with_bars(queries, balls, size, k, decimals)
    stored = input_bytes(balls.table) or 0
    tasks = max(parallelism(spark), math.ceil(stored / resident))
    offer = _offer_reachable(balls.centres, balls.metric, decimals)
    lists = balls.table.select("centre", "inner", "outer", "bids", "bvecs").coalesce(tasks).mapInArrow(
        sweep(_ball_packs(balls.dim, k), balls.dim, k, balls.metric, decimals, tiles, offer, resident, count), LIST_SCHEMA
    )
    together = lists.repartition("query_id").sortWithinPartitions("query_id")
    return together.mapInArrow(merge_lists(k, decimals), RESULT_SCHEMA)
