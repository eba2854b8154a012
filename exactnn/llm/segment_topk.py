"""Exact top-k search by inner product, with bounds from segment statistics.

Cut two vectors into segments. With the means m and deviations s of a segment of n components,
n * ((m1 - m2)**2 + (s1 - s2)**2) is at most its share of the squared distance; summed over the
segments this bounds the distance from below, the finer the segmentation the closer. Pairs of a query
and a candidate whose bound is beyond the query's k-th distance so far are left out, from coarse to
fine; only the others are measured, exactly on integers. Inner products follow from distances and norms.

Vectors travel as packed blocks. A first pass gives each query a bar, its k-th score in a sample of
the base, so that every cell can leave out pairs from its first block on; a bar only spares work.
Query groups meet base shards in cells of bounded size; each cell returns k rows per query at most,
which one window merges.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from exactnn.operators.topk import kth_bound, least_of_groups, ranked, reached
from exactnn.session import materialize, parallelism

#: Rows of a packed block, and bytes of all blocks of a group of queries or a shard of the base.
BLOCK_ROWS = 4096
CELL_BYTES = 64 << 20
#: Segments of the resolutions, coarse to fine.
RESOLUTIONS = (4, 16)
#: Rows of the sample that the first bars come from, about.
SAMPLE_ROWS = 4096
_TILE_QUERIES = 256
_TILE_BASE = 2048
#: Share of a tile's pairs up to which survivors are measured one by one, not as a product.
_FEW = 0.05

_BLOCK = "dim int, n int, kind string, ids binary, comps binary, part int, nth long"


def valid_vectors(df: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """id, vector: integers floor(scale * x) of the rows whose components are all finite."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    scaled = F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double")))
    return df.where(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0) & finite).select(
        F.col(id_col).cast("long").alias("id"), scaled.alias("vector")
    )


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (id, vector) as blocks of vectors of one dimension, in the smallest integer type."""
    from pyspark import TaskContext

    part, nth = TaskContext.get().partitionId(), 0
    for batch in batches:
        ids = batch.column("id").to_numpy()
        sizes = np.diff(batch.column("vector").offsets.to_numpy())
        flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
        begin = np.cumsum(sizes) - sizes
        for dim in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == dim)
            for a in range(0, len(rows), BLOCK_ROWS):
                own = rows[a : a + BLOCK_ROWS]
                values = flat[begin[own][:, None] + np.arange(dim)]
                most = max(int(values.max()), -int(values.min()))
                if most >= 1 << 53:
                    raise ValueError("components of 2**53 or more have no exact inner products here")
                kind = next(t for t in ("<i2", "<i4", "<i8") if most <= np.iinfo(t).max)
                yield pa.RecordBatch.from_pydict(
                    {
                        "dim": pa.array([dim], pa.int32()), "n": pa.array([len(own)], pa.int32()),
                        "kind": [kind], "ids": [ids[own].astype("<i8").tobytes()],
                        "comps": [values.astype(kind).tobytes()],
                        "part": pa.array([part], pa.int32()), "nth": [nth],
                    }
                )
                nth += 1


class _Side:
    """The vectors of a block with their norms and statistics at each resolution."""

    def __init__(self, ids: bytes, comps: bytes, kind: str, dim: int):
        self.ids = np.frombuffer(ids, "<i8")
        self.comps = np.frombuffer(comps, kind).reshape(-1, dim)
        self.most = max(int(self.comps.max(initial=0)), -int(self.comps.min(initial=0)))
        vectors = self.comps.astype(np.float64)
        self.norms = np.einsum("ij,ij->i", vectors, vectors)
        self.levels = [_statistics(vectors, r) for r in RESOLUTIONS if r < dim]
        self._kinds: dict[type, np.ndarray] = {}

    def as_kind(self, kind: type) -> np.ndarray:
        if kind not in self._kinds:
            self._kinds[kind] = self.comps.astype(kind)
        return self._kinds[kind]


def _statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """sqrt(n) * mean and sqrt(n) * deviation of each segment, as float32."""
    sizes = np.array([len(part) for part in np.array_split(np.arange(vectors.shape[1]), segments)])
    begin = np.cumsum(sizes) - sizes
    mean = np.add.reduceat(vectors, begin, axis=1) / sizes
    away = vectors - np.repeat(mean, sizes, axis=1)
    spread = np.sqrt(np.add.reduceat(away * away, begin, axis=1))
    return np.hstack([np.sqrt(sizes) * mean, spread]).astype(np.float32)


class _Best:
    """The best rows of each query of a block so far: score down, id up."""

    def __init__(self, queries: _Side, k: int, bar: np.ndarray | None = None):
        self.q, self.k = queries, k
        n = len(queries.ids)
        self.bar = np.full(n, -np.inf) if bar is None else bar.copy()
        self.pairs = self.survivors = 0
        self.row = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)

    def add(self, rows: slice, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """Rank what was found for the queries ``rows``, and nothing else, with what they hold."""
        if not any(len(row) for row, _, _ in found):
            return
        held = (self.row, self.id, self.score)
        a, b = np.searchsorted(self.row, (rows.start, rows.stop))
        found = [tuple(x[a:b] for x in held), *found]
        row, ids, score = (np.concatenate(parts) for parts in zip(*found, strict=True))
        if np.abs(score).max() < 1 << 53 and ids.max() < 1 << 40:
            order = ranked(row, -score.astype(np.float64), ids, 0)
        else:
            order = np.lexsort((ids, -score, row))
        row, ids, score = row[order], ids[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < self.k
        self.row, self.id, self.score = (
            np.concatenate([old[:a], new[keep], old[b:]]) for old, new in zip(held, (row, ids, score), strict=True)
        )
        last = np.flatnonzero(place == self.k - 1)
        bar = score[last].astype(np.float64)
        bar = np.where(np.abs(bar) < 1 << 53, bar, np.nextafter(bar, -np.inf))
        self.bar[row[last]] = np.maximum(self.bar[row[last]], bar)


def _search(best: _Best, base: _Side, skip_self: bool) -> None:
    """Offer the rows of ``base`` to the queries.

    What a tile finds waits until there is enough to rank, or until a query has no bar yet.
    """
    q, dim = best.q, best.q.comps.shape[1]
    largest = dim * max(1, q.most) * max(1, base.most)
    if largest >= 1 << 53 and dim * q.most * base.most >= 1 << 63:
        raise ValueError("inner products overflow 64 bits")
    # sums of whole numbers are exact in the smallest of these types that holds the largest one
    kind = np.float32 if largest < 1 << 24 else np.float64 if largest < 1 << 53 else np.int64
    for a in range(0, len(q.ids), _TILE_QUERIES):
        rows = slice(a, min(a + _TILE_QUERIES, len(q.ids)))
        one, found, waiting = q.as_kind(kind)[rows], [], 0
        for b in range(0, len(base.ids), _TILE_BASE):
            columns = np.arange(b, min(b + _TILE_BASE, len(base.ids)))
            best.pairs += len(one) * len(columns)
            alive, columns = _survivors(best, base, rows, columns)
            left = int(np.count_nonzero(alive))
            best.survivors += left
            if not left:
                continue
            other, bar = base.as_kind(kind)[columns], best.bar[rows]
            own, ids = q.ids[rows] if skip_self else None, base.ids[columns]
            if left < _FEW * alive.size:
                row, column = np.divmod(np.flatnonzero(alive), len(columns))
                score = np.einsum("ij,ij->i", one[row], other[column])
                good = score >= bar[row]
            else:
                less = -one @ other.T
                row, column = _tile_best(less, bar, best.k, own, ids)
                score = -less[row, column]
                good = np.ones(len(row), bool)
            if skip_self:
                good &= own[row] != ids[column]
            found.append((row[good] + a, ids[column[good]], score[good].astype(np.int64)))
            waiting += len(found[-1][0])
            if waiting > best.k * len(one) // 2 or np.isneginf(bar).any():
                best.add(rows, found)
                found, waiting = [], 0
        best.add(rows, found)


def _survivors(best: _Best, base: _Side, rows: slice, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that the bounds of no resolution rule out, and the columns they are of, without most that have none."""
    q, bar = best.q, best.bar[rows]
    alive = np.ones((len(bar), len(columns)), bool)
    if np.isneginf(bar).all():
        return alive, columns
    norms, biggest = q.norms[rows], base.norms[columns].max()
    for ours, theirs in zip(q.levels, base.levels, strict=True):
        # the statistics' products are less the larger, by half, of norms less the distance's bound
        rounding = (ours.shape[1] + 8) * 2.0**-23 * np.sqrt(norms * biggest)
        limit = bar - rounding - (1e-9 * (norms + biggest) + 1e-6) / 2
        limit = np.nextafter(limit.astype(np.float32), np.float32(-np.inf))
        alive &= ours[rows] @ theirs[columns].T >= limit[:, None]
        some = np.flatnonzero(alive.any(axis=0))
        if len(some) < 0.75 * len(columns):
            alive, columns = alive[:, some], columns[some]
    return alive, columns


def _tile_best(
    less: np.ndarray, bar: np.ndarray, k: int, own: np.ndarray | None, ids: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places of the negative scores that reach the bar, or are among the best k about of a row without one.

    A few more are let through by rounding; rows of a query's own id may be among them.
    """
    open_ = np.isneginf(bar)
    some = open_.any() and less.shape[1] > k
    if some and own is not None:
        less[own[:, None] == ids] = np.inf if less.dtype.kind == "f" else np.iinfo(np.int64).max
    least = least_of_groups(less)
    bound = (-bar).astype(np.float32)
    if some:
        bound[open_] = kth_bound(less, least, k, open_)
    return reached(less, least, np.nextafter(bound, np.float32(np.inf)))


def _cells(k: int, skip_self: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, _Best] = {}
        cell = None
        side: tuple | None = None
        for batch in batches:
            for r in batch.to_pylist():
                if (r["g"], r["s"], r["dim"]) != cell:
                    yield from _found(best)
                    best, cell, side = {}, (r["g"], r["s"], r["dim"]), None
                query = (r["q_part"], r["q_nth"])
                if query not in best:
                    bar = np.frombuffer(r["q_bars"], np.float64)
                    best[query] = _Best(_Side(r["q_ids"], r["q_comps"], r["q_kind"], r["dim"]), k, bar)
                name = (r["part"], r["nth"])
                if side is None or side[0] != name:
                    side = (name, _Side(r["ids"], r["comps"], r["kind"], r["dim"]))
                _search(best[query], side[1], skip_self)
        yield from _found(best)

    return run


def _first_bars(k: int, skip_self: bool):
    """Query blocks with the k-th score of each query among the sample's blocks, which come with them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bars = []
            for r in batch.to_pylist():
                best = _Best(_Side(r["ids"], r["comps"], r["kind"], r["dim"]), k)
                for block in r["sample"] or ():
                    _search(best, _Side(block["ids"], block["comps"], block["kind"], r["dim"]), skip_self)
                bars.append(best.bar.tobytes())
            own = [c for c in batch.schema.names if c != "sample"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in own], pa.array(bars, pa.binary())], [*own, "bars"])

    return run


def _sample(base: DataFrame, n: int, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """Valid vectors of about SAMPLE_ROWS of n rows, dealt by the hash of the ids, in one partition.

    Every task of the scan picks its own, by the hash first: vectors are looked at only for rows picked.
    """
    dealt = F.pmod(F.xxhash64(F.col(id_col).cast("long"), F.lit(9)), F.lit(max(1, n // SAMPLE_ROWS)))
    return valid_vectors(base.where(dealt == 0), id_col, vector_col, scale).repartition(1)


def _with_bars(asked: DataFrame, sample: DataFrame, k: int, skip_self: bool) -> DataFrame:
    """Query blocks and their first bars."""
    packed = materialize(sample.mapInArrow(_pack, _BLOCK), "sample")
    # equal ids have one hash: the sample is broadcast only if it is as small as it should be
    size = packed.agg(F.coalesce(F.sum(F.length("comps")), F.lit(0)).alias("bytes")).first().bytes
    sample = packed.groupBy("dim").agg(F.collect_list(F.struct("ids", "comps", "kind")).alias("sample"))
    if size > CELL_BYTES:
        sample = sample.limit(0)
    met = asked.join(F.broadcast(sample), "dim", "left").select("dim", "n", "kind", "ids", "comps", "part", "nth", "sample")
    return materialize(met.mapInArrow(_first_bars(k, skip_self), f"{_BLOCK}, bars binary"), "bars")


def _found(best: dict[tuple, _Best]) -> Iterator[pa.RecordBatch]:
    for b in best.values():
        if len(b.row):
            yield pa.RecordBatch.from_arrays(
                [pa.array(b.q.ids[b.row]), pa.array(b.id), pa.array(b.score)],
                ["query_id", "vec_id", "score"],
            )


def top_k(
    queries: DataFrame,
    base: DataFrame,
    k: int = 20,
    scale: float = 64.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    skip_self: bool = True,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest integer inner products.

    Components are floor(scale * x). Ties go to the smaller id; a query with fewer candidates
    gets all. Rows with a null id, a null or empty vector, or a null or non-finite component take
    no part; vectors of different dimensions do not meet. Ids name rows: of rows that share an
    id each is a candidate, and a query never meets rows of its own id (``skip_self``). Empty
    tables give an empty result.
    """
    spark = base.sparkSession
    rows = materialize(valid_vectors(base, id_col, vector_col, scale).mapInArrow(_pack, _BLOCK), "base")
    asked = materialize(
        valid_vectors(queries, id_col, vector_col, scale).mapInArrow(_pack, _BLOCK), "queries"
    )
    bytes_of = F.coalesce(F.sum(F.length("comps") + F.length("ids")), F.lit(0))
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), bytes_of.alias("bytes")).first()
    q_size = asked.agg(F.count("*").alias("n"), bytes_of.alias("bytes")).first()
    groups = max(1, math.ceil(q_size.bytes / CELL_BYTES))
    spare = math.ceil(3 * parallelism(spark) / groups)
    shards = max(1, math.ceil(size.bytes / CELL_BYTES), min(size.n, spare))

    asked = _with_bars(asked, _sample(base, size.rows, id_col, vector_col, scale), k, skip_self)
    place = F.xxhash64("part", "nth")
    left = asked.select(
        "dim",
        F.pmod(place, F.lit(groups)).cast("int").alias("g"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("s"),
        *[F.col(c).alias(f"q_{c}") for c in ("kind", "ids", "comps", "part", "nth", "bars")],
    )
    right = rows.select(
        "dim", "kind", "ids", "comps", "part", "nth",
        F.pmod(place, F.lit(shards)).cast("int").alias("s"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"),
    )
    cells = left.hint("merge").join(right, ["g", "s", "dim"])
    found = cells.mapInArrow(_cells(k, skip_self), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
