"""Exact top-k of a block of query vectors over a stream of base vectors (runs in tasks).

Each batch of base vectors goes through two steps. A float32 matrix product screens it: a pair
survives if its score could still enter the query's current top k, given the worst rounding a
float32 dot product of that length can have. The few survivors are then measured in float64 on
the original components and ranked by (distance, base_id), on the full float64 distance unless
``decimals`` asks for rounded ones. The screen only ever lets too much through, so the result is
that of full float64 evaluation.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_NO_ID = np.iinfo(np.int64).max
_UNIT = 2.0**-24  # rounding unit of float32
_ROUNDING = 2.0**-50  # of float64 distances of about 1, and of products too small for float32
_MAX_NORM = 1e18  # products and squares up to here are finite in float32
TILE_ROWS = 512  # queries scored at a time, so that a tile of scores stays in the cache
GROUP = 16  # scores of a query of which only the least is looked at first
FEW_COLUMNS = 256  # below this all scores are looked at
_VERIFY_ELEMENTS = 1 << 18  # float64 components gathered at a time, for the same reason
_KEY_LIMIT = 1 << 40  # a sort key holds a number up to this, and above it a row or run
_KEY_RUNS = 1 << 20
_buffers: dict[str, np.ndarray] = {}


def vector_matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Arrow list column -> (rows, dim) float32 matrix, without copying where possible."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten()
    if column.null_count or flat.null_count or len(flat) != len(column) * dim:
        raise ValueError(f"every vector needs {dim} non-null components")
    matrix = flat.to_numpy(zero_copy_only=False).astype(np.float32, copy=False).reshape(-1, dim)
    if not np.isfinite(matrix).all():
        raise ValueError("vectors need finite components")
    return matrix


def drop_surplus_copies(
    ids: np.ndarray, vectors: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Keep the k smallest ids of every group of identical vectors in a batch.

    Copies are equally far from any query and equal distances rank by id, so the (k+1)-th copy
    can never be in a top k. This keeps a hot vector from passing the screen once per copy.
    """
    if len(ids) <= k:
        return ids, vectors
    plus_zero = np.ascontiguousarray(vectors + np.float32(0.0))
    keys = plus_zero.view(np.dtype((np.void, plus_zero.shape[1] * 4))).ravel()
    _, group = np.unique(keys, return_inverse=True)
    order = np.lexsort((ids, group))
    keep = order[_place_in_run(group[order]) < k]
    if len(keep) == len(ids):
        return ids, vectors
    keep.sort()
    return ids[keep], vectors[keep]


def _place_in_run(sorted_keys: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... within each run of equal keys."""
    n = len(sorted_keys)
    starts = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])
    return np.arange(n) - np.repeat(starts, np.diff(np.r_[starts, n]))


def ranked(
    rows: np.ndarray, dist: np.ndarray, ids: np.ndarray, decimals: int | None = None
) -> np.ndarray:
    """Order by (row, distance, id).

    Of distances rounded to ``decimals``, row and distance fit one integer in nearly all cases,
    and so do the run of equal ones and the id; sorting integers is many times faster than
    sorting by three keys.
    """
    if decimals is None:
        return np.lexsort((ids, dist, rows))
    unfilled = ~np.isfinite(dist)
    steps = np.rint(np.where(unfilled, 0.0, dist) * 10.0**decimals)
    if not _fits(np.abs(steps)) or (len(rows) and rows.max() >= _KEY_RUNS):
        return np.lexsort((ids, dist, rows))
    steps = np.where(unfilled, _KEY_LIMIT, steps.astype(np.int64))
    key = rows.astype(np.int64) * (4 * _KEY_LIMIT) + (steps + _KEY_LIMIT)
    order = np.argsort(key)
    ordered = key[order]
    same = ordered[1:] == ordered[:-1]
    if same.any():
        places = np.flatnonzero(np.r_[False, same] | np.r_[same, False])
        order[places] = _by_id(order[places], ordered[places], ids)
    return order


def _by_id(members: np.ndarray, keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """``members``, in runs of equal ``keys``, sorted by id within each run."""
    values = ids[members]
    values = np.where(values == _NO_ID, _KEY_LIMIT, values)
    run = np.cumsum(np.r_[0, keys[1:] != keys[:-1]])
    if not _fits(values) or values.min() < 0 or run[-1] >= _KEY_RUNS:
        return members[np.lexsort((ids[members], run))]
    return members[np.argsort(run * (4 * _KEY_LIMIT) + values)]


def _fits(values: np.ndarray) -> bool:
    return not len(values) or values.max() <= _KEY_LIMIT


def _buffer(name: str, shape: tuple[int, int], dtype) -> np.ndarray:
    """A reused work area: fresh pages for every block would cost more than the product."""
    need = shape[0] * shape[1]
    if name not in _buffers or _buffers[name].size < need:
        _buffers[name] = np.empty(need, dtype)
    return _buffers[name][:need].reshape(shape)


def least_of_groups(score: np.ndarray) -> np.ndarray:
    """The least score of each group of GROUP columns, which lie as far apart as there are groups.

    Columns left over at the end, fewer than GROUP, are in no group; fewer than FEW_COLUMNS make none.
    """
    return _grouped(score)[0].min(axis=1)


def _grouped(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    groups = score.shape[1] // GROUP if score.shape[1] >= FEW_COLUMNS else 0
    whole = GROUP * groups
    return score[:, :whole].reshape(len(score), GROUP, groups), score[:, whole:]


def kth_bound(score: np.ndarray, least: np.ndarray, k: int, rows: np.ndarray) -> np.ndarray:
    """For each of the rows a bound that k of its scores reach: the k-th of the groups' least ones if these are many."""
    values = (least if least.shape[1] >= 4 * k else score)[rows]
    return np.partition(values.astype(np.float32, copy=False), k - 1, axis=1)[:, k - 1]


def reached(score: np.ndarray, least: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the scores within the bound of their row, in no certain order."""
    body, rest = _grouped(score)
    groups = least.shape[1]
    found = np.flatnonzero(least <= bound[:, None])
    if len(found) > least.size // 4 or not groups:
        return np.divmod(np.flatnonzero(score <= bound[:, None]), score.shape[1])
    row, group = np.divmod(found, groups)
    hit, at = np.divmod(np.flatnonzero(body[row, :, group] <= bound[row, None]), GROUP)
    rows, cols = row[hit], at * groups + group[hit]
    if rest.shape[1]:
        more, at = np.nonzero(rest <= bound[:, None])
        rows, cols = np.concatenate([rows, more]), np.concatenate([cols, at + GROUP * groups])
    return rows, cols


class BlockTopK:
    """Running top k of one block of queries.

    Survivors are collected and merged into the ranking in groups. Meanwhile the old k-th place
    is the bar for new ones, which lets a few more through and loses none. ``bar`` holds, for each
    query, a distance within which k base rows are known elsewhere: farther ones are left out.
    """

    def __init__(
        self, query_ids: np.ndarray, queries: np.ndarray, k: int, metric: str,
        decimals: int | None = None, bar: np.ndarray | None = None,
    ):
        self.decimals = decimals
        self.bar = np.full(len(query_ids), np.inf) if bar is None else bar.copy()
        self.products = 0  # pairs scored so far
        # copies: the arguments are views of an Arrow batch that should not stay in memory
        self.query_ids, self.k, self.metric = query_ids.copy(), k, metric
        self.queries = np.array(queries, dtype=np.float32)
        wide = self.queries.astype(np.float64)
        self.query_sq = np.einsum("ij,ij->i", wide, wide)
        self.query_norm = np.sqrt(self.query_sq)
        self.left = _screen_queries(self.queries, wide, self.query_norm, metric)
        self.dist = np.full((len(query_ids), k), np.inf)
        self.ids = np.full((len(query_ids), k), _NO_ID, dtype=np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting_rows = 0

    def offer(self, base_ids: np.ndarray, base: np.ndarray, some: np.ndarray | None = None) -> None:
        """Rank base rows for all queries, or for the places ``some`` among them."""
        wide = base.astype(np.float64)
        norms = np.sqrt(np.einsum("ij,ij->i", wide, wide))
        biggest = float(norms.max(initial=0.0))
        if max(biggest, float(self.query_norm.max(initial=0.0))) > _MAX_NORM:
            raise ValueError(f"vectors longer than {_MAX_NORM:g} overflow float32 products")
        right = _screen_base(base, wide, norms, self.metric)
        slack = self._slack(base.shape[1], biggest)
        queries = len(self.query_ids) if some is None else len(some)
        self.products += queries * len(base)
        for top in range(0, queries, TILE_ROWS):
            tile = slice(top, top + TILE_ROWS)
            if some is not None:
                tile = some[tile]
            left = self.left[tile]
            score = _buffer("score", (len(left), len(base)), np.float32)
            np.matmul(left, right, out=score)
            least = least_of_groups(score)
            rows, cols = reached(score, least, self._bound(tile, score, least, slack[tile]))
            if len(rows):
                exact = self._measure(tile, rows, cols, wide, norms)
                self._admit(rows + top if some is None else tile[rows], base_ids[cols], exact)

    def kth(self) -> np.ndarray:
        """For each query the distance beyond which nothing is wanted any more."""
        self._merge()
        return np.minimum(self.dist[:, -1], self.bar)

    def _slack(self, dim: int, biggest: float) -> np.ndarray:
        """Largest error of a float32 score, per query, for base norms up to ``biggest``."""
        gamma = (dim + 8) * _UNIT / (1 - (dim + 8) * _UNIT)
        if self.metric == "sqeuclidean":
            return gamma * (2 * self.query_norm * biggest + biggest**2) + 8 * _UNIT * (
                self.query_norm + biggest
            ) ** 2
        if self.metric == "cosine":
            return np.full(len(self.query_ids), 2 * gamma)
        # the screen orders by the product; only the ranked distance, in float64, is one less it
        return gamma * self.query_norm * biggest + _ROUNDING

    def _bound(self, tile, score: np.ndarray, least: np.ndarray, slack: np.ndarray) -> np.ndarray:
        """Largest score per query that may still enter the top k."""
        worst = np.minimum(self.dist[tile, -1], self.bar[tile])
        shift = -self.query_sq[tile] if self.metric == "sqeuclidean" else -1.0
        known = worst + shift + slack
        unfilled = np.isinf(worst)
        if unfilled.any() and score.shape[1] > self.k:
            known[unfilled] = kth_bound(score, least, self.k, unfilled) + 2 * slack[unfilled]
        # one rounding step of the distance, if any, and of the float32 comparison on top
        if self.decimals is not None:
            known = known + 10.0**-self.decimals
        known = (known + np.abs(known) * 2 * _UNIT).astype(np.float32)
        return np.nextafter(known, np.float32(np.inf))

    def _measure(self, tile, rows, cols, wide, norms) -> np.ndarray:
        queries = self.queries[tile].astype(np.float64)
        exact = np.empty(len(rows))
        step = max(1, _VERIFY_ELEMENTS // wide.shape[1])
        for at in range(0, len(rows), step):
            part = slice(at, at + step)
            q = np.take(queries, rows[part], axis=0)
            b = np.take(wide, cols[part], axis=0)
            if self.metric == "sqeuclidean":
                q -= b
                b = q
            np.einsum("ij,ij->i", q, b, out=exact[part])
        if self.metric == "cosine":
            scale = self.query_norm[tile][rows] * norms[cols]
            exact = np.divide(exact, scale, out=np.zeros_like(exact), where=scale > 0)
        if self.metric != "sqeuclidean":
            exact = 1.0 - exact
        if self.decimals is None:
            return exact + 0.0
        scale = 10.0**self.decimals
        return np.floor(exact * scale + 0.5) / scale + 0.0

    def _admit(self, rows: np.ndarray, ids: np.ndarray, dist: np.ndarray) -> None:
        last_d, last_id = self.dist[rows, -1], self.ids[rows, -1]
        better = (dist < last_d) | ((dist == last_d) & (ids < last_id))
        better &= dist <= self.bar[rows]
        if better.any():
            self.waiting.append((rows[better], ids[better], dist[better]))
            self.waiting_rows += len(self.waiting[-1][0])
        if self.waiting_rows > self.dist.size // 2 or np.isinf(np.minimum(last_d, self.bar[rows])).any():
            self._merge()

    def _merge(self) -> None:
        if not self.waiting:
            return
        rows, ids, dist = (np.concatenate(part) for part in zip(*self.waiting))
        self.waiting, self.waiting_rows = [], 0
        touched = np.unique(rows)
        all_rows = np.concatenate([np.repeat(touched, self.k), rows])
        all_ids = np.concatenate([self.ids[touched].ravel(), ids])
        all_dist = np.concatenate([self.dist[touched].ravel(), dist])
        order = ranked(all_rows, all_dist, all_ids, self.decimals)
        keep = order[_place_in_run(all_rows[order]) < self.k]
        self.ids[touched] = all_ids[keep].reshape(len(touched), self.k)
        self.dist[touched] = all_dist[keep].reshape(len(touched), self.k)

    def batches(self, places_per_batch: int = 1 << 18):
        """One (query_id, base_ids, distances) row per query that found any, in batches."""
        self._merge()
        step = max(1, places_per_batch // self.k)
        found = np.flatnonzero(np.isfinite(self.dist[:, 0]))
        for at in range(0, len(found), step):
            own = found[at:at + step]
            dist, ids = self.dist[own], self.ids[own]
            filled = np.isfinite(dist)
            offsets = pa.array(np.r_[0, np.cumsum(filled.sum(axis=1))], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(self.query_ids[own]),
                    pa.ListArray.from_arrays(offsets, pa.array(ids[filled])),
                    pa.ListArray.from_arrays(offsets, pa.array(dist[filled])),
                ],
                names=["query_id", "base_ids", "distances"],
            )


def merge_lists(k: int, decimals: int | None = None):
    """Rank the lists of each query; the stream has the rows of one query side by side.

    The last query of a batch may go on in the next one, so its best k are carried over.
    """

    def best(queries, ids, dist):
        # the stream is sorted by query, so its queries can be numbered as they come
        number = np.cumsum(np.r_[0, queries[1:] != queries[:-1]])
        order = ranked(number, dist, ids, decimals)
        place = _place_in_run(queries[order])
        keep = place < k
        order = order[keep]
        return queries[order], ids[order], dist[order], place[keep]

    def rows(queries, ids, dist, place):
        return pa.RecordBatch.from_arrays(
            [pa.array(queries), pa.array(place, pa.int32()), pa.array(ids), pa.array(dist)],
            names=["query_id", "rank", "base_id", "distance"],
        )

    def merge(batches):
        carried = None
        for batch in batches:
            lists = batch.column(1)
            queries = np.repeat(batch.column(0).to_numpy(), lists.value_lengths().to_numpy())
            ids, dist = lists.flatten().to_numpy(), batch.column(2).flatten().to_numpy()
            if carried is not None:
                queries, ids, dist = (
                    np.concatenate(pair) for pair in zip(carried, (queries, ids, dist))
                )
            if not len(queries):
                continue
            found = best(queries, ids, dist)
            end = np.searchsorted(found[0], found[0][-1])
            carried = tuple(part[end:] for part in found[:3])
            if end:
                yield rows(*(part[:end] for part in found))
        if carried is not None:
            yield rows(*best(*carried))

    return merge


def _unit_rows(matrix: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return np.divide(matrix, norms[:, None], out=np.zeros_like(matrix), where=norms[:, None] > 0)


def _screen_queries(queries, wide, norms, metric: str) -> np.ndarray:
    """Left factor of the screen: its product with the right one orders like the distance."""
    if metric == "sqeuclidean":  # -2 q.b + 1 * b.b
        return np.hstack([-2 * queries, np.ones((len(queries), 1), np.float32)])
    if metric == "cosine":
        return -_unit_rows(wide, norms).astype(np.float32)
    return -queries


def _screen_base(base, wide, norms, metric: str) -> np.ndarray:
    if metric == "sqeuclidean":
        return np.hstack([base, (norms * norms).astype(np.float32)[:, None]]).T
    if metric == "cosine":
        return _unit_rows(wide, norms).astype(np.float32).T
    return base.T
