"""Exact k-nearest-neighbour join: every query vector against every base vector.

The work is Q x B by definition, but no row pair ever exists in Spark. Vectors move in blocks, a
task multiplies block by block and keeps a running top k, and what is shuffled afterwards is one
row per query and task: its k best of that task. These lists are ranked where they meet.

Two physical forms give the same rows:

``broadcast``
    The base is read once and never shuffled. Query blocks are broadcast, which is done only
    after a count has shown that they, and the running top k that each task holds for them, fit
    ``broadcast_bytes``.
``grid``
    For larger query sets. Queries are stored in the shared folder as tiles. The base is read once
    as well: a task keeps RESIDENT_BYTES of its split in memory and lets the tiles pass over them,
    one at a time. The first tasks leave there how far each query's k-th place is for them; later
    ones look it up, and return only what is nearer, so the lists to merge hardly grow with the
    number of tasks. A bar that is missing, or written twice by a repeated task, changes no result.

The query side is read twice, so store it first where it is expensive to make, such as vectors
that a model is still to compute.

Both ids have to be unique integers. Ids decide every placement by hash, so a task that is run
again on another executor sees the same rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exactnn.functions.vectors import METRICS
from exactnn.operators.topk import BlockTopK, drop_surplus_copies, merge_lists, vector_matrix
from exactnn.session import MAX_PARTITIONS, MIB, input_bytes, parallelism, scratch_path
from exactnn.sources.xvec import open_path

LIST_SCHEMA = "query_id long, base_ids array<long>, distances array<double>"
RESULT_SCHEMA = "query_id long, rank int, base_id long, distance double"
BROADCAST_BYTES = 64 * MIB  # an executor has a task, and so this state, on every core
BLOCK_BYTES = 4 * MIB
BLOCK_ROWS = 2048
TASK_BYTES = 2048 * MIB
PLACE_BYTES, MERGE_BYTES = 16, 256 * MIB  # of a place in a list, and of lists a merge task reads
ROWS_PER_PLACE = 500  # base rows a task should read for each of the k places it returns
LIST_BYTES = 64 * MIB  # of all lists from a base of unknown size, before it gets fewer tasks than splits
RESIDENT_BYTES = 256 * MIB  # base vectors that a task of the grid form holds at a time
BAR_TASKS = 16  # tasks that leave their k-th places for others
TILES_PER_FILE = 16  # a task reads the tiles of a file at once
TILE_SCHEMA = "qblock int, qids binary, qvecs binary"


@dataclass(frozen=True)
class QuerySize:
    """Measured size of the query side."""

    rows: int
    dim: int

    def bytes(self, k: int) -> int:
        """Vectors (plain and normalised) plus the running top k, as one task holds them."""
        return self.rows * (8 * self.dim + 24 * k + 32)


def measure_queries(query: DataFrame, vector: str = "embedding") -> QuerySize:
    found = query.agg(
        F.count("*").alias("n"),
        F.min(F.size(vector)).alias("low"),
        F.max(F.size(vector)).alias("high"),
    ).first()
    if found.n and found.low != found.high:
        raise ValueError(f"query vectors have between {found.low} and {found.high} components")
    return QuerySize(found.n, found.high or 0)


def block_rows(dim: int) -> int:
    return max(64, min(BLOCK_ROWS, BLOCK_BYTES // (4 * max(1, dim))))


def task_count(base: DataFrame, k: int, dim: int) -> int | None:
    """One to four base tasks per core, more if a task would read over 2 GiB.

    None where the size of the base is unknown, as of a data source in Python: see
    :func:`list_tasks`.

    Up to four per core balance the load; but each task returns k places per query however
    little it read, so tasks of few rows for their k are not worth it.
    """
    cores, size = parallelism(base.sparkSession), input_bytes(base)
    if size is None:
        return None
    rows = size // (4 * max(1, dim))
    balanced = min(4 * cores, max(cores, rows // (ROWS_PER_PLACE * k)))
    return max(balanced, math.ceil(size / TASK_BYTES))


def list_tasks(base: DataFrame, k: int, size: QuerySize) -> int:
    """Most tasks for a base of unknown size, where the splits say nothing about its rows.

    Each task returns a list for every query, so with small splits the lists would outgrow the
    vectors. They are held to LIST_BYTES, but with one task per core at least, in whole rounds.
    """
    cores = parallelism(base.sparkSession)
    return cores * max(1, LIST_BYTES // max(1, cores * size.rows * k * PLACE_BYTES))


def knn_join(
    query: DataFrame, base: DataFrame, k: int = 100, metric: str = "sqeuclidean", **options
) -> DataFrame:
    """k nearest base rows of every query: (query_id, rank, base_id, distance), rank from 0.

    Distances are full float64 ones, ranked by (distance, base_id); with ``decimals`` they are
    rounded first and ties rank by id. With fewer than k base rows every query gets them all. See
    :func:`knn_lists` for the options.
    """
    size = options.pop("size", None) or measure_queries(query, options.get("vector", "embedding"))
    lists = knn_lists(query, base, k, metric, size=size, **options)
    tasks = options.get("base_tasks") or task_count(base, k, size.dim) or list_tasks(base, k, size)
    parts = math.ceil(size.rows * k * tasks * PLACE_BYTES / MERGE_BYTES)
    default = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [min(parts, MAX_PARTITIONS), "query_id"] if parts > default else ["query_id"]
    together = lists.repartition(*keys).sortWithinPartitions("query_id")
    return together.mapInArrow(merge_lists(k, options.get("decimals")), RESULT_SCHEMA)


def knn_partials(
    query: DataFrame, base: DataFrame, k: int = 100, metric: str = "sqeuclidean", **options
) -> DataFrame:
    """:func:`knn_lists` as rows: (query_id, base_id, distance)."""
    lists = knn_lists(query, base, k, metric, **options)
    return lists.select("query_id", F.inline(F.arrays_zip("base_ids", "distances"))).toDF(
        "query_id", "base_id", "distance"
    )


def knn_lists(
    query: DataFrame,
    base: DataFrame,
    k: int = 100,
    metric: str = "sqeuclidean",
    *,
    query_id: str = "query_id",
    base_id: str = "base_id",
    vector: str = "embedding",
    strategy: str = "auto",
    broadcast_bytes: int = BROADCAST_BYTES,
    base_tasks: int | None = None,
    size: QuerySize | None = None,
    decimals: int | None = None,
) -> DataFrame:
    """Top k of every query within each base task: (query_id, base_ids, distances).

    ``base_tasks`` caps the number of tasks, so that the lists to merge do not grow with the
    number of input splits (default: see :func:`task_count` and :func:`list_tasks`). ``size`` saves
    the count of the query side where the caller knows it.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, got {metric!r}")
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = base.sparkSession
    size = size or measure_queries(query, vector)
    if not size.rows:
        return spark.createDataFrame([], LIST_SCHEMA)
    if strategy == "auto":
        strategy = "broadcast" if size.bytes(k) <= broadcast_bytes else "grid"
    queries = query.select(F.col(query_id).cast("long").alias("id"), F.col(vector).alias("vec"))
    rows = base.select(F.col(base_id).cast("long").alias("id"), F.col(vector).alias("vec"))
    tasks = base_tasks or task_count(rows, k, size.dim) or list_tasks(rows, k, size)
    if strategy == "broadcast":
        if size.bytes(k) > broadcast_bytes:
            raise ValueError("query side exceeds broadcast_bytes; use strategy='grid'")
        return _broadcast_form(queries, rows, k, metric, size, tasks, decimals)
    if strategy == "grid":
        return _grid_form(queries, rows, k, metric, size, tasks, decimals)
    raise ValueError(f"unknown strategy {strategy!r}")


def _broadcast_form(
    queries, rows, k, metric, size: QuerySize, tasks: int, decimals: int | None
) -> DataFrame:
    dim, per_block = size.dim, block_rows(size.dim)
    query_blocks, blocks = _query_blocks(queries, size)
    base_packs = rows.coalesce(tasks).mapInArrow(
        _pack_base(dim, k, per_block), "leading boolean, bids binary, bvecs binary"
    )
    # the first pack of a task meets every query block through an equi-join on its number and so
    # brings them into the task, once; the later packs pass through with no block
    every = F.sequence(F.lit(0), F.lit(blocks - 1))
    number = F.explode(F.when(F.col("leading"), every).otherwise(F.array(F.lit(None).cast("int"))))
    paired = base_packs.withColumn("qblock", number).join(
        F.broadcast(query_blocks), "qblock", "left"
    )
    return paired.select("qblock", "qids", "qvecs", "bids", "bvecs").mapInArrow(
        _screen_packs(dim, k, metric, decimals), LIST_SCHEMA
    )


def _query_blocks(queries: DataFrame, size: QuerySize) -> tuple[DataFrame, int]:
    blocks = math.ceil(size.rows / block_rows(size.dim))
    numbered = queries.withColumn("qblock", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    return numbered.groupBy("qblock").applyInArrow(_pack_queries(size.dim), TILE_SCHEMA), blocks


def _grid_form(
    queries, rows, k, metric, size: QuerySize, tasks: int, decimals: int | None
) -> DataFrame:
    tiles = scratch_path(rows.sparkSession, "tiles")
    _query_blocks(queries, size)[0].write.option("maxRecordsPerFile", TILES_PER_FILE).parquet(tiles)
    packs = rows.coalesce(tasks).mapInArrow(
        sweep(_packs_of(size.dim, k), size.dim, k, metric, decimals, tiles, resident=RESIDENT_BYTES), LIST_SCHEMA
    )
    return packs


class Pack(NamedTuple):
    """Base rows that are scored together; ``ball`` says where they lie, if that is known."""

    ids: np.ndarray
    vectors: np.ndarray
    ball: tuple | None = None


def _packs_of(dim: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[Pack]]:
    per_block = block_rows(dim)

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[Pack]:
        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(), vector_matrix(batch.column(1), dim)
            for at in range(0, len(ids), per_block):
                kept, own = drop_surplus_copies(ids[at:at + per_block], vectors[at:at + per_block], k)
                yield Pack(kept.copy(), own.copy())

    return packs


class Tile(NamedTuple):
    ids: np.ndarray
    vectors: np.ndarray
    bar: np.ndarray | None


def read_tiles(path: str, dim: int, dtype=np.float32) -> Iterator[Tile]:
    """The query tiles stored at ``path``, always in one order, one in memory at a time."""
    system, root = open_path(path)
    found = system.get_file_info(fs.FileSelector(root))
    for name in sorted(i.path for i in found if i.base_name.endswith(".parquet")):
        with system.open_input_file(name) as file:
            for batch in pq.ParquetFile(file).iter_batches(batch_size=1):
                cell = {c: batch.column(c)[0].as_buffer() for c in batch.schema.names if c in ("qids", "qvecs", "qbars")}
                bar = np.frombuffer(cell["qbars"], np.float64) if "qbars" in cell else None
                yield Tile(
                    np.frombuffer(cell["qids"], np.int64),
                    np.frombuffer(cell["qvecs"], dtype).reshape(-1, dim), bar,
                )


class _Bars:
    """k-th places that other tasks have left, in the order of the tiles; and a place for one's own."""

    def __init__(self, path: str):
        self._system, self._root = open_path(path)
        self._system.create_dir(self._root, recursive=True)
        found = self._system.get_file_info(fs.FileSelector(self._root))
        self._files = [self._system.open_input_file(i.path) for i in found if i.base_name.endswith(".bar")]
        self._own = None

    def next(self, n: int) -> np.ndarray | None:
        if not self._files:
            return None
        return np.min([np.frombuffer(f.read(8 * n), np.float64) for f in self._files], axis=0)

    def leave(self, number: int, kth: np.ndarray) -> None:
        if self._own is None:
            self._name = f"{self._root}/{number:04d}"
            self._draft = f"{self._name}-{uuid.uuid4().hex}.tmp"
            self._own = self._system.open_output_stream(self._draft)
        self._own.write(kth.astype(np.float64).tobytes())

    def close(self) -> None:
        """What was left becomes visible to others at once, and only whole."""
        for file in self._files:
            file.close()
        if self._own is not None:
            self._own.close()
            self._system.move(self._draft, f"{self._name}.bar")


def sweep(
    packs_of, dim: int, k: int, metric: str, decimals: int | None, tiles: str,
    offer: Callable | None = None, resident: int = RESIDENT_BYTES, count=None, kernel=BlockTopK, dtype=np.float32,
):
    """Task function of the grid form: lists of the queries in ``tiles`` for each resident part.

    ``offer(top, packs)`` ranks the packs for a tile (all of them for all queries by default);
    ``count`` takes the number of pairs scored; ``kernel`` ranks vectors of ``dtype``.
    """

    def every(top: BlockTopK, packs: list[Pack]) -> None:
        for pack in packs:
            top.offer(pack.ids, pack.vectors)

    def part(packs: list[Pack], number: int | None) -> Iterator[pa.RecordBatch]:
        bars = _Bars(f"{tiles}.bars")
        for tile in read_tiles(tiles, dim, dtype):
            bar = bars.next(len(tile.ids))
            if tile.bar is not None:
                bar = tile.bar if bar is None else np.minimum(bar, tile.bar)
            top = kernel(tile.ids, tile.vectors, k, metric, decimals, bar)
            (offer or every)(top, packs)
            if count is not None:
                count.add(top.products)
            if number is not None:
                bars.leave(number, top.kth())
            yield from top.batches()
        bars.close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        number = number if number < BAR_TASKS else None
        held, size = [], 0
        for pack in packs_of(batches):
            held.append(pack)
            size += pack.vectors.nbytes
            if size >= resident:
                yield from part(held, number)
                held, size, number = [], 0, None
        if held:
            yield from part(held, number)

    return run


def _pack_queries(dim: int):
    def pack(table: pa.Table) -> pa.Table:
        return pa.table({
            "qblock": table.column("qblock").slice(0, 1).cast(pa.int32()),
            "qids": pa.array([table.column("id").to_numpy().astype(np.int64).tobytes()]),
            "qvecs": pa.array([vector_matrix(table.column("vec"), dim).tobytes()]),
        })

    return pack


def _pack_base(dim: int, k: int, per_block: int):
    def pack(batches):
        leading = True
        for batch in batches:
            ids = batch.column(0).to_numpy()
            vectors = vector_matrix(batch.column(1), dim)
            for at in range(0, len(ids), per_block):
                kept, rows = drop_surplus_copies(
                    ids[at:at + per_block], vectors[at:at + per_block], k
                )
                yield pa.RecordBatch.from_pydict(
                    {"leading": [leading], "bids": [kept.tobytes()], "bvecs": [rows.tobytes()]}
                )
                leading = False

    return pack


def _screen_packs(dim: int, k: int, metric: str, decimals: int | None):
    def array(cell, dtype):
        return np.frombuffer(cell.as_buffer(), dtype)

    def screen(batches):
        tops: dict[int, BlockTopK] = {}
        complete = False
        for batch in batches:
            blocks = batch.column(0).to_pylist()
            qids, qvecs, bids, bvecs = (batch.column(i) for i in range(1, 5))
            for i, block in enumerate(blocks):
                ids, vectors = array(bids[i], np.int64), array(bvecs[i], np.float32)
                vectors = vectors.reshape(-1, dim)
                if block is None:
                    complete = True
                    for top in tops.values():
                        top.offer(ids, vectors)
                elif qids[i].is_valid:  # a block that no query hashes to has none
                    if complete or block in tops:
                        raise RuntimeError("query blocks have to lead the packs of a task")
                    tops[block] = BlockTopK(
                        array(qids[i], np.int64),
                        array(qvecs[i], np.float32).reshape(-1, dim),
                        k,
                        metric,
                        decimals,
                    )
                    tops[block].offer(ids, vectors)
        for top in tops.values():
            yield from top.batches()

    return screen
