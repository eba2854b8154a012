"""Arrow batches as flat numpy buffers, and small numpy helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a task looks at in one numpy step; a longer text is a step of its own.
SLICE_BYTES = 2 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)
_BASE = 0xD6E8FEB86659FD93


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under fixed names; a null text is an empty one."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, one after another, and len + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if large else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges that hold at most ``limit`` bytes, or one row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(rows, max(last, first + 1))
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int = 0) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit words."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 20)) * _ODD)


_BYTE_VALUES = seeds(256, 7)
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd number modulo 2**64, and of its inverse."""
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, SLICE_BYTES + (1 << 16))
        for name, base in (("_powers", _BASE), ("_inverse", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)
    return _powers[:n], _inverse[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of consecutive or disjoint, ascending, non-empty spans of ``data``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = powers(len(data) + 1)
    weighted = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * power[:-1], out=weighted[1:])
    sums = (weighted[ends] - weighted[starts]) * inverse[starts]
    return mix(sums + (ends - starts).astype(np.uint64) * _ODD)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all spans (start, length), one span after another."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)


def whitespace_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than space and \\t..\\r, and words per row."""
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.ones(len(data) + 1, bool)
    edge[:-1] = gap
    inside = ~gap
    begins = inside.copy()
    begins[1:] &= gap[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = inside[firsts]
    closes = inside & edge[1:]
    lasts = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    closes[lasts] = inside[lasts]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(closes) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts
