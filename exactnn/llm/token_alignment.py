"""Alignment of two tokenizers on whole texts, by products of sparse token-byte incidence matrices.

The tokens of a text by tokenizer A, and those by B, each tile its bytes. With one row a token and
one column a byte, both are sparse 0/1 matrices, kept here as plain row pointers and column
indices. Row by row, after Gustavson, A times the transpose of B gives the links: the pairs of
tokens whose bytes overlap, with the number of bytes they share. Byte offsets where tokens of both
end cut the tokens into groups; the token-group matrices multiplied in the same way give the
shared-group links.

Corpus-wide counts of linked id pairs are summed in the tasks first, then by ranges of B ids, whose
number of pairs the vocabularies bound. They come back to the documents in groups of ranges of
measured size, as broadcasts; a document carries its own distinct pairs, so no text is read twice.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exactnn.llm.arrow import id_and_text, ragged, slices, text_buffer
from exactnn.llm.pretoken import WordMemo, character_classes
from exactnn.llm.speculative_bpe import PART_BYTES, codec
from exactnn.session import MIB, materialize

#: Entries of a product that are held at once.
BLOCK_ENTRIES = 4 << 20
#: Cells (B ids of a range times A ids) in which counts are summed.
RANGE_CELLS = 4 << 20
#: Pairs that a task sums before it hands them on, and tasks whose sums one task adds up.
HELD_PAIRS, FAN_IN = 4 << 20, 512
#: Bytes of counts that are broadcast at once.
BROADCAST_BYTES = 64 * MIB
_PAIR_BYTES = 13

_DIGEST = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_shared long, groups_sha256 string, keys binary, counts binary"


class Csr(NamedTuple):
    """A sparse 0/1 matrix: the columns of row i are ``idx[ptr[i]:ptr[i + 1]]``."""

    ptr: np.ndarray
    idx: np.ndarray


def csr_product(a: Csr, b: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of the product, by row and column.

    For every entry (i, k) of ``a`` row k of ``b`` is added to row i; entries of one column are
    merged where they meet.
    """
    sizes = np.diff(b.ptr)[a.idx]
    col = b.idx[ragged(b.ptr[a.idx], sizes)]
    row = np.repeat(np.repeat(np.arange(len(a.ptr) - 1), np.diff(a.ptr)), sizes)
    if not len(row):
        return row, col, row
    key = row * (int(col.max()) + 1) + col
    if (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        row, col, key = row[order], col[order], key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return row[first], col[first], np.diff(np.append(first, len(key)))


def overlap_links(len_a: np.ndarray, len_b: np.ndarray, block: int = BLOCK_ENTRIES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, bytes) of overlapping tokens, in blocks of rows, of tokens that tile the same bytes."""
    end_a, end_b = np.cumsum(len_a), np.cumsum(len_b)
    row = 0
    while row < len(len_a):
        begin = int(end_a[row] - len_a[row])
        last = max(row + 1, int(np.searchsorted(end_a, begin + block, "right")))
        stop = int(end_a[last - 1])
        ptr = np.concatenate([[0], end_a[row:last] - begin])
        low, high = np.searchsorted(end_b, begin, "right"), np.searchsorted(end_b, stop, "left") + 1
        inside = np.minimum(end_b[low:high], stop) - np.maximum(end_b[low:high] - len_b[low:high], begin)
        bytes_ = np.arange(stop - begin)
        a = Csr(ptr, bytes_)
        b = Csr(np.append(bytes_, stop - begin), np.repeat(np.arange(low, high), inside))
        i, j, shared = csr_product(a, b)
        yield i + row, j, shared
        row = last


def groups_of(len_a: np.ndarray, len_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B."""
    end_a, end_b = np.cumsum(len_a), np.cumsum(len_b)
    total = int(end_a[-1]) if len(end_a) else 0
    found = []
    for own, other in ((end_a, end_b), (end_b, end_a)):
        mark = np.zeros(total + 1, bool)
        mark[other] = True
        closes = mark[own]
        found.append(np.cumsum(closes) - closes)
    return found[0], found[1]


def shared_group_links(group_a: np.ndarray, group_b: np.ndarray, block: int = BLOCK_ENTRIES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, 1) of tokens of one group, in blocks of rows."""
    n = int(group_b[-1]) + 1 if len(group_b) else 0
    members = Csr(np.searchsorted(group_b, np.arange(n + 1)), np.arange(len(group_b)))
    reach = np.concatenate([[0], np.cumsum(np.diff(members.ptr)[group_a])]) if n else np.zeros(1, np.int64)
    row = 0
    while row < len(group_a):
        last = max(row + 1, int(np.searchsorted(reach, reach[row] + block, "right")) - 1)
        i, j, one = csr_product(Csr(np.arange(last - row + 1), group_a[row:last]), members)
        yield i + row, j, one
        row = last


class Aligner:
    """Both encoders, and the bytes of their ids."""

    def __init__(self, path_a: str, path_b: str, classes: bytes):
        import sentencepiece

        self._a = codec(path_a, classes, special=False)
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece holds a space behind other characters")
        self._bytes_b = [
            bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.size_a, self.size_b = len(self._a.model.bytes), len(pieces)
        self.length_a = np.fromiter(map(len, self._a.model.bytes), np.int64, self.size_a)
        # one more, for what is not the text's own bytes
        self.length_b = np.fromiter(map(len, [*self._bytes_b, b""]), np.int64, self.size_b + 1)
        self._space = self._b.piece_to_id("▁")
        self._memo = WordMemo(self._pieces)

    def _pieces(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of words that begin with a space, which the model adds itself.

        No piece reaches over a space that follows another character, so that words are encoded
        by themselves. A word whose pieces are not its bytes becomes the id after the last one.
        """
        found = self._b.encode([w[1:].decode() for w in words], num_threads=1)
        table = self._bytes_b
        ids = [
            ([self._space] if len(w) == 1 else own) for w, own in zip(words, found, strict=True)
        ]
        ids = [own if b"".join([table[i] for i in own]) == w else [self.size_b] for w, own in zip(words, ids, strict=True)]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for own in ids for i in own), np.int32, int(counts.sum())), counts

    def _encode_b(self, data: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        space = data == 32
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[texts[:-1]] = True
        starts = np.flatnonzero(begins)
        cuts = np.unique(np.searchsorted(starts, np.arange(0, len(data), PART_BYTES)))
        cuts = [c for c in cuts.tolist() if c < len(starts)] + [len(starts)]
        ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            stop = int(starts[b]) if b < len(starts) else len(data)
            rows = self._memo.rows(data[starts[a] : stop], starts[a:b] - starts[a])
            ids.append(self._memo.ids(rows))
            counts.append(self._memo.counts(rows))
        total = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        return np.concatenate(ids), total[np.searchsorted(starts, texts)]

    def encode(self, data: np.ndarray, texts: np.ndarray):
        """Per text whether it has tokens; ids of A and bounds, ids of B and bounds, of those that do.

        ``data``: texts, none empty, each behind a space of its own.
        """
        ids_a, bounds_a = self._a.encode(data, texts)
        ids_b, bounds_b = self._encode_b(data, texts)
        size = np.diff(texts)
        good = np.ones(len(size), bool)
        for ids, bounds, length in ((ids_a, bounds_a, self.length_a), (ids_b, bounds_b, self.length_b)):
            total = np.concatenate([[0], np.cumsum(length[ids])])
            good &= total[bounds[1:]] - total[bounds[:-1]] == size
        foreign = np.concatenate([[0], np.cumsum(ids_b == self.size_b)])
        good &= foreign[bounds_b[1:]] == foreign[bounds_b[:-1]]
        sides = []
        for ids, bounds in ((ids_a, bounds_a), (ids_b, bounds_b)):
            counts = np.diff(bounds)
            sides += [ids[np.repeat(good, counts)].astype(np.int64), np.concatenate([[0], np.cumsum(counts[good])])]
        return good, *sides


@functools.lru_cache(maxsize=1)
def _aligner(path_a: str, path_b: str, classes: bytes) -> Aligner:
    return Aligner(path_a, path_b, classes)


def _spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that are not empty, their texts behind a space each, and the texts' offsets."""
    rows = np.flatnonzero(np.diff(offsets))
    bounds = np.concatenate([[0], np.cumsum(np.diff(offsets)[rows] + 1)])
    out = np.full(int(bounds[-1]), 32, np.uint8)
    own = np.ones(len(out), bool)
    own[bounds[:-1]] = False
    out[own] = data
    return rows, out, bounds


def _decimals(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the numbers below n, each with a place for a separator; their starts and sizes."""
    words = [b"%d," % i for i in range(n)]
    size = np.fromiter(map(len, words), np.int64, n)
    return np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size, size


_digits: dict[int, tuple] = {}


def group_strings(ids_a, ids_b, group_a, group_b) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;`` of all groups as bytes, and where each group ends."""
    n = max(int(ids_a.max(initial=0)), int(ids_b.max(initial=0))) + 1
    if n not in _digits:
        _digits.clear()
        _digits[n] = _decimals(n)
    flat, start, size = _digits[n]
    groups = int(group_a[-1]) + 1
    many_a, many_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    upto_a, upto_b = np.cumsum(many_a), np.cumsum(many_b)
    order = np.empty(len(ids_a) + len(ids_b), np.int64)
    order[np.arange(len(ids_a)) + (upto_b - many_b)[group_a]] = ids_a
    order[np.arange(len(ids_b)) + upto_a[group_b]] = ids_b
    sizes = size[order]
    text = flat[ragged(start[order], sizes)]
    ends = np.cumsum(sizes)
    text[ends[upto_a + upto_b - many_b - 1] - 1] = ord("|")
    closing = ends[upto_a + upto_b - 1]
    text[closing - 1] = ord(";")
    return text, closing


def _digest(tool: Aligner, data: np.ndarray, offsets: np.ndarray, ids: pa.Array) -> pa.RecordBatch:
    """Rows of _DIGEST for the texts of one step."""
    n = len(offsets) - 1
    columns = {name: np.zeros(n, np.int64) for name in ("n_a", "n_b", "n_groups", "n_links", "n_shared")}
    sha = [""] * n
    span = tool.size_a * tool.size_b
    keys, counts, many = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n, np.int64)
    rows, spaced, bounds = _spaced(data, offsets)
    if len(rows):
        good, ids_a, at_a, ids_b, at_b = tool.encode(spaced, bounds)
        rows = rows[good]
    if len(rows):
        len_a, len_b = tool.length_a[ids_a], tool.length_b[ids_b]
        group_a, group_b = groups_of(len_a, len_b)
        many_a, many_b = np.bincount(group_a), np.bincount(group_b)
        upto = np.append(group_a, group_a[-1] + 1)[at_a]  # groups before each text
        shared = np.concatenate([[0], np.cumsum(many_a * many_b)])
        doc = np.repeat(np.arange(len(rows)), np.diff(at_a))
        parts = []
        for a, b, _ in overlap_links(len_a, len_b):
            columns["n_links"][rows] += np.bincount(doc[a], minlength=len(rows))
            parts.append(np.unique(doc[a] * span + ids_b[b] * tool.size_a + ids_a[a], return_counts=True))
        found, counts = (np.concatenate(p) for p in zip(*parts, strict=True))
        if len(parts) > 1:
            found, place = np.unique(found, return_inverse=True)
            counts = np.bincount(place, counts).astype(np.int64)
        many[rows] = np.bincount(found // span, minlength=len(rows))
        keys = found % span
        for name, values in (("n_a", at_a), ("n_b", at_b), ("n_groups", upto), ("n_shared", shared[upto])):
            columns[name][rows] = np.diff(values)
        text, closing = group_strings(ids_a, ids_b, group_a, group_b)
        ends = np.concatenate([[0], closing[upto[1:] - 1]]).tolist()
        for row, a, b in zip(rows.tolist(), ends, ends[1:], strict=False):
            sha[row] = hashlib.sha256(text[a : b - 1]).hexdigest()
    bounds = np.concatenate([[0], np.cumsum(many)])
    packed = [_binary(keys.astype(_key_type(span)), bounds), _binary(counts.astype("<u4"), bounds)]
    return pa.RecordBatch.from_arrays(
        [ids, *[pa.array(c) for c in columns.values()], pa.array(sha, pa.string()), *packed],
        ["doc_id", *columns, "groups_sha256", "keys", "counts"],
    )


def _key_type(span: int) -> str:
    return "<u4" if span <= 1 << 32 else "<u8"


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Runs of ``values`` as binaries."""
    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _ranges(keys: np.ndarray, counts: np.ndarray, cells: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(range, keys, counts) of sorted keys."""
    part = keys // cells
    edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(keys)]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield int(part[a]), keys[a:b], counts[a:b]


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    return every, np.bincount(place, np.concatenate(counts), len(every)).astype(np.int64)


def _partial_counts(span: int, cells: int):
    """The pairs of a task, summed, as one row for each range of B ids."""

    def rows(keys, counts) -> pa.RecordBatch:
        found = list(_ranges(*_summed(keys, counts), cells))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r for r, _, _ in found], pa.int64()),
                pa.array([k.astype("<i8").tobytes() for _, k, _ in found], pa.binary()),
                pa.array([c.astype("<i8").tobytes() for _, _, c in found], pa.binary()),
            ],
            ["part", "keys", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                some = batch.slice(first, 256)
                k, _ = text_buffer(some.column("keys").cast(pa.large_binary()))
                c, _ = text_buffer(some.column("counts").cast(pa.large_binary()))
                keys.append(k.view(_key_type(span)).astype(np.int64))
                counts.append(c.view("<u4"))
                held += len(keys[-1])
                if held > HELD_PAIRS:
                    every, total = _summed(keys, counts)
                    if len(every) > HELD_PAIRS // 2:
                        yield rows([every], [total])
                        every, total = every[:0], total[:0]
                    keys, counts, held = [every], [total], len(every)
        if held:
            yield rows(keys, counts)

    return run


def _added(cells: int, size_a: int, last: bool):
    """Sums of the rows of one range after another; the ``last`` ones with each B id's best marked."""

    def close(part: int, total: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(total)
        columns = [pa.array([part], pa.int64())]
        for values in (at + part * cells, total[at]):
            columns.append(pa.array([values.astype("<i8").tobytes()], pa.binary()))
        names = ["part", "keys", "counts"]
        if last:
            best = total.reshape(-1, size_a).max(axis=1)[at // size_a] == total[at]
            columns += [pa.array([best.tobytes()], pa.binary()), pa.array([len(at)], pa.int64())]
            names += ["best", "pairs"]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, total = None, None
        for batch in batches:
            salts = batch.column("salt").to_pylist()
            for row, (part, salt) in enumerate(zip(batch.column("part").to_pylist(), salts, strict=True)):
                if (part, salt) != group:
                    if group is not None:
                        yield close(group[0], total)
                    group, total = (part, salt), np.zeros(cells, np.int64)
                keys = np.frombuffer(batch.column("keys")[row].as_buffer(), "<i8")
                total[keys - part * cells] += np.frombuffer(batch.column("counts")[row].as_buffer(), "<i8")
        if group is not None:
            yield close(group[0], total)

    return run


def pair_counts(digests: DataFrame, size_a: int, size_b: int) -> DataFrame:
    """(part, keys, counts, best, pairs): corpus-wide counts of linked id pairs by range of B ids.

    A key is B id * ``size_a`` + A id; ``best`` marks the pairs of their B id's highest count. A
    range's sums are dense and of fixed size. Sums of more than FAN_IN tasks are added in two steps.
    """
    cells = max(1, RANGE_CELLS // size_a) * size_a
    schema = "part long, keys binary, counts binary"
    sums = digests.select("keys", "counts").mapInArrow(_partial_counts(size_a * size_b, cells), schema)
    tasks = sums.rdd.getNumPartitions()
    for salts in ([math.ceil(tasks / FAN_IN)] if tasks > FAN_IN else []) + [1]:
        dealt = F.pmod(F.spark_partition_id(), F.lit(salts)).cast("int").alias("salt")
        sums = sums.select("part", dealt, "keys", "counts").repartition("part", "salt").sortWithinPartitions("part", "salt")
        more = ", best binary, pairs long" if salts == 1 else ""
        sums = sums.mapInArrow(_added(cells, size_a, salts == 1), schema + more)
    return materialize(sums, "pair_counts")


def _looked_up(known, span: int):
    """Per row the sum of its links' counts and the number of its links that are best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, total, best = known.value
        for batch in batches:
            raw, offsets = text_buffer(batch.column("keys").cast(pa.large_binary()))
            own, _ = text_buffer(batch.column("counts").cast(pa.large_binary()))
            keys, times = raw.view(_key_type(span)).astype(np.int64), own.view("<u4").astype(np.int64)
            at = np.minimum(np.searchsorted(every, keys), max(0, len(every) - 1))
            hit = every[at] == keys if len(every) else np.zeros(len(keys), bool)
            sums = [np.where(hit, total[at] * times, 0), np.where(hit & best[at], times, 0)] if len(every) else [times * 0] * 2
            bounds = offsets // np.dtype(_key_type(span)).itemsize
            out = []
            for values in sums:
                upto = np.concatenate([[0], np.cumsum(values)])
                out.append(pa.array(upto[bounds[1:]] - upto[bounds[:-1]]))
            columns = [batch.column(c) for c in batch.schema.names if c not in ("keys", "counts")]
            names = [c for c in batch.schema.names if c not in ("keys", "counts")]
            yield pa.RecordBatch.from_arrays([*columns, *out], [*names, "count_sum", "n_best"])

    return run


def _groups(sizes: list[tuple[int, int]], limit: int) -> Iterator[list[int]]:
    held, filled = [], 0
    for part, pairs in sizes:
        if held and filled + pairs * _PAIR_BYTES > limit:
            yield held
            held, filled = [], 0
        held.append(part)
        filled += pairs * _PAIR_BYTES
    yield held


def align(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_shared, n_best, count_sum, groups_sha256 of every row.

    A is a byte-level BPE file on a space and the text, B a piece model on the text. ``n_links``:
    overlapping pairs of tokens; ``n_shared``: pairs of one group; ``count_sum``: over the links,
    how many links of all rows have the same two ids; ``n_best``: links whose count is the highest
    of their B id. ``groups_sha256`` is over ``a1,a2|b1;a3|b2,b3``.

    Null and empty texts, and texts that either tokenizer changes, have no tokens: zeros and ''.
    Rows with equal or null ids are each counted; other columns are not looked at, whatever their
    names; of no rows nothing is returned. Memory: one step of at most 2 MiB or one text, some 60
    bytes a byte, and the counts of one group of at most ``broadcast_bytes`` or one range.
    """
    spark = docs.sparkSession
    classes = character_classes(path_a)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _aligner(path_a, path_b, classes)
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for first, last in slices(offsets):
                part = data[offsets[first] : offsets[last]]
                ids = batch.column("doc_id").slice(first, last - first)
                yield _digest(tool, part, offsets[first : last + 1] - offsets[first], ids)

    digests = id_and_text(docs, id_col, text_col).mapInArrow(run, _DIGEST)
    digests = materialize(digests.withColumn("row", F.monotonically_increasing_id()), "digests")
    tool = _sizes(path_a, path_b)
    counts = pair_counts(digests, *tool)
    sizes = [(r.part, r.pairs) for r in counts.select("part", "pairs").orderBy("part").collect()]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256", "row"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in digests.select(*names).schema)
    span = tool[0] * tool[1]
    found = None
    for group in _groups(sizes, broadcast_bytes):
        rows = counts.where(F.col("part").isin(group)).orderBy("part").toArrow() if group else counts.limit(0).toArrow()
        known = [text_buffer(rows.column(c).cast(pa.large_binary()))[0].view(t) for c, t in (("keys", "<i8"), ("counts", "<i8"), ("best", bool))]
        held = spark.sparkContext.broadcast(known)
        part = digests.select(*names, "keys", "counts").mapInArrow(
            _looked_up(held, span), f"{schema}, count_sum long, n_best long"
        )
        found = part if found is None else found.unionByName(part)
    if len(list(_groups(sizes, broadcast_bytes))) > 1:
        kept = [F.first(c).alias(c) for c in names if c != "row"]
        found = found.groupBy("row").agg(*kept, F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "n_best", "count_sum", "groups_sha256"
    )


@functools.lru_cache(maxsize=4)
def _sizes(path_a: str, path_b: str) -> tuple[int, int]:
    import json

    import sentencepiece

    with open(path_a) as file:
        size_a = max(json.load(file)["model"]["vocab"].values()) + 1
    return size_a, sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()


def token_links(
    docs: DataFrame, path_a: str, path_b: str, kind: str = "overlap", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, a_pos, a_id, b_pos, b_id, weight: the links themselves, one row each.

    ``kind``: "overlap" (weight: shared bytes) or "group" (tokens of one group, weight 1). Texts
    without tokens have no rows; the rest is as :func:`align` has it.
    """
    if kind not in ("overlap", "group"):
        raise ValueError("kind is overlap or group")
    classes = character_classes(path_a)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _aligner(path_a, path_b, classes)
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for first, last in slices(offsets):
                rows, spaced, bounds = _spaced(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                if not len(rows):
                    continue
                good, ids_a, at_a, ids_b, at_b = tool.encode(spaced, bounds)
                rows = rows[good] + first
                sides = tool.length_a[ids_a], tool.length_b[ids_b]
                links = overlap_links(*sides) if kind == "overlap" else shared_group_links(*groups_of(*sides))
                for a, b, weight in links:
                    doc = np.searchsorted(at_a, a, "right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(pa.array(rows[doc])), pa.array(a - at_a[doc]), pa.array(ids_a[a]),
                            pa.array(b - at_b[doc]), pa.array(ids_b[b]), pa.array(weight.astype(np.int64)),
                        ],
                        ["doc_id", "a_pos", "a_id", "b_pos", "b_id", "weight"],
                    )

    schema = "doc_id long, a_pos long, a_id long, b_pos long, b_id long, weight long"
    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)
