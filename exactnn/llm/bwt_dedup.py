"""Removal of long repeated byte strings, found by interval expansion on a Burrows-Wheeler transform.

Two equal strings of ``length`` bytes hold the same minimizer, the least hash of a shorter gram in
them. Texts are cut into segments, runs of windows of one minimizer, and only segments that share
a minimizer can share a string:

* segments whose minimizer is met nowhere else, also not again in the segment itself, hold nothing
  repeated and never move;
* segments that are copies as a whole are repeated as a whole, decided by counting;
* of the others, one of each content is fetched and goes to a block with all that share its
  minimizer. There the Burrows-Wheeler transform of the block gives common prefixes by increasing
  length: breadth-first, the intervals of strings of n bytes are extended by the byte before, and
  what ends there is a common prefix of n bytes exactly. At ``length`` the search stops; suffixes
  without a value share ``length`` bytes or more.
* a minimizer with more content than a block takes is dealt to several blocks, whose windows are
  then compared by hash; each block sends every distinct one once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exactnn.llm.arrow import _BYTE_VALUES, mix, powers, ragged, slices, text_buffer
from exactnn.session import materialize, parallelism

LENGTH = 400
#: Bytes of the gram whose least hash in a window is the window's minimizer.
GRAM = 128
#: Text cut in one step, and windows of a segment at most.
PIECE_BYTES = 2 << 20
SEGMENT_WINDOWS = 1024
#: Content of a block: wanted, and at most before a minimizer is dealt to several.
BLOCK_BYTES, HOT_BYTES = 1 << 20, 4 << 20

#: Tasks for blocks at most: each pair of a map task and one of them is a shuffle block.
MAX_TASKS = 10_000

_NULL_ID = -(1 << 63)


# --- segments ----------------------------------------------------------------------------------


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, from running minima of blocks of that width."""
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: len(x) - width + 1], ahead[width - 1 : len(x)])


def _prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    power, inverse = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * power[:-1], out=sums[1:])
    return sums, inverse


def segments(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(minimizer, content hash, start, size, turns) of the segments of all texts in ``data``.

    ``turns``: a window begins with the minimizer and the next one of the segment has another
    occurrence of it; only then can a segment repeat a string within itself.
    """
    if len(data) < length:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, bool))
    sums, inverse = _prefix_sums(data)
    hashes = mix((sums[gram:] - sums[:-gram]) * inverse[: len(data) - gram + 1])
    least = _sliding_least(hashes, length - gram + 1)
    sizes = np.diff(offsets)
    long = sizes >= length
    opens = np.bincount(offsets[:-1][long], minlength=len(least) + 1)
    whole = opens - np.bincount(offsets[1:][long] - length + 1, minlength=len(least) + 1)
    inside = np.cumsum(whole[:-1]) > 0
    change = np.ones(len(least), bool)
    change[1:] = (least[1:] != least[:-1]) | ~inside[:-1]
    starts = np.flatnonzero(change & inside)
    change[:-1] = (least[1:] != least[:-1]) | ~inside[1:]
    change[-1] = True
    ends = np.flatnonzero(change & inside) + 1
    parts = -(-(ends - starts) // SEGMENT_WINDOWS)
    nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = np.repeat(starts, parts) + nth * SEGMENT_WINDOWS
    end = np.minimum(begin + SEGMENT_WINDOWS, np.repeat(ends, parts)) + length - 1
    content = mix((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64))
    leaves = np.concatenate([[0], np.cumsum(hashes[: len(least)] == least)])
    turns = leaves[end - length] > leaves[begin]
    return least[begin], content, begin, end - begin, turns


def _pieces(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first row, last row + 1, begin, end): steps of whole rows, or of parts of one long row.

    Parts overlap by one byte less than a window, so that every window is in one part.
    """
    for first, last in slices(offsets, PIECE_BYTES):
        begin, end = int(offsets[first]), int(offsets[last])
        if last - first > 1 or end - begin <= PIECE_BYTES:
            yield first, last, begin, end
            continue
        while True:
            stop = min(end, begin + PIECE_BYTES)
            yield first, last, begin, stop
            if stop == end:
                break
            begin = stop - length + 1


def _segment_rows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            ids, hashes = batch.column("id"), batch.column("h")
            for first, last, begin, end in _pieces(offsets, length):
                bounds = np.clip(offsets[first : last + 1], begin, end) - begin
                minimizer, content, start, size, turns = segments(data[begin:end], bounds, length, gram)
                row = first + np.searchsorted(bounds, start, "right") - 1
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(minimizer.view(np.int64)), pa.array(content.view(np.int64)), ids.take(take),
                        hashes.take(take), pa.array(start + begin - offsets[row]), pa.array(size.astype(np.int32)),
                        pa.array(turns),
                    ],
                    ["v", "c", "id", "h", "start", "size", "turns"],
                )

    return run


# --- blocks ------------------------------------------------------------------------------------


def suffix_array(text: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and its inverse of strings that each end with a 0 of its own.

    ``text``: bytes + 1 and the zeros; ``begins``: starts of the strings. Zeros differ, in the order
    of their strings. Prefixes of 8 bytes are sorted first, then doubled where not yet told apart.
    """
    n = len(text)
    last = np.repeat(np.append(begins[1:], n), np.diff(np.append(begins, n))) - 1  # own zero
    left = last - np.arange(n)
    key = np.zeros(n, np.uint64)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    for i in range(8):
        key = key << np.uint64(8) | np.where(i <= left, padded[i : i + n], 0).astype(np.uint64)
    order = np.argsort(key, kind="stable")
    head = np.ones(n, bool)
    head[1:] = (key[order[1:]] != key[order[:-1]]) | (left[order[1:]] < 8)
    group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = group
    step = 8
    while True:
        single = head & np.append(head[1:], True)
        at = np.flatnonzero(~single)
        if not len(at):
            return order, rank
        own = order[at]
        wide = rank[own] * (n + 1) + rank[own + step]
        new = np.argsort(wide, kind="stable")
        own, wide = own[new], wide[new]
        order[at] = own
        head[at[1:]] |= wide[1:] != wide[:-1]
        head[at] |= left[own] < 2 * step
        group = np.maximum.accumulate(np.where(head[at], at, 0))
        rank[own] = group
        step *= 2


def repeated_places(text: np.ndarray, begins: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether the string of ``length`` bytes at each place stands elsewhere too; a name for each class.

    Breadth-first over the intervals of strings in the suffix array: extending a string by the
    byte before it leads to the interval of a string one longer, and if the place after that has
    no value, the suffixes there part after the string. Only intervals that gave a value go on.
    """
    order, rank = suffix_array(text, begins)
    n = len(text)
    before = np.where(order > 0, text[order - 1], 0)
    to = np.where(order > 0, rank[order - 1], 0)  # the suffix one byte longer
    parted = np.zeros(n + 1, bool)
    parted[0] = parted[n] = True
    # strings of one byte; each zero is one of its own
    first = text[order]
    lows = np.flatnonzero(np.append(True, (first[1:] != first[:-1]) | (first[1:] == 0)))
    highs = np.append(lows[1:], n) - 1
    parted[lows] = True
    for _ in range(1, length):
        if not len(lows):
            break
        size = highs - lows + 1
        one = size == 1
        lo = lows[one]
        lo = to[lo[before[lo] > 0]]
        hi = lo
        if not one.all():
            lows, size = lows[~one], size[~one]
            place = ragged(lows, size)
            byte = before[place]
            key = np.repeat(np.arange(len(lows)) * 256, size) + byte
            place, key = place[byte > 0], key[byte > 0]
            sort = np.argsort(key, kind="stable")
            place, key = place[sort], key[sort]
            edge = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            lo = np.concatenate([lo, to[place[edge]]])
            hi = np.concatenate([hi, to[place[np.append(edge[1:], len(key)) - 1]]]) if len(key) else hi
        new = ~parted[hi + 1]
        lows, highs = lo[new], hi[new]
        parted[highs + 1] = True
    same = ~parted[:n]  # shares its string with the suffix before
    found = np.zeros(n, bool)
    found[order[same]] = True
    found[order[:-1][same[1:]]] = True
    name = np.empty(n, np.int64)
    name[order] = np.cumsum(parted[:n])
    return found, name


class _Block:
    """Rows of one block: segments with their place in the texts."""

    def __init__(self, batches: list[pa.RecordBatch], length: int):
        table = pa.Table.from_batches(batches)
        self.column = lambda name: table.column(name).to_numpy()
        self.length = length
        content, offsets = text_buffer(table.column("content").cast(pa.large_binary()))
        sizes = np.diff(offsets)
        self.begins = offsets[:-1] + np.arange(len(sizes))
        self.text = np.zeros(len(content) + len(sizes), np.uint8)
        self.text[ragged(self.begins, sizes)] = content + np.uint8(1)  # UTF-8 has no byte 255
        self.sizes = sizes

    def rows(self) -> Iterator[pa.RecordBatch]:
        found, name = repeated_places(self.text, self.begins, self.length)
        windows = self.sizes - self.length + 1
        place = ragged(self.begins, windows)
        row = np.repeat(np.arange(len(windows)), windows)
        hit = found[place]
        edge = np.ones(len(place), bool)
        edge[1:] = (row[1:] != row[:-1]) | (hit[1:] != hit[:-1])
        starts = np.flatnonzero(edge)
        ends = np.append(starts[1:], len(place))
        keep = hit[starts]
        starts, ends = starts[keep], ends[keep]
        own = row[starts]
        at = place[starts] - self.begins[own] + self.column("start")[own]
        yield self._batch(own, at, at + (ends - starts) + self.length - 1, None, None)
        hot = np.flatnonzero(self.column("hot")[row])
        if len(hot):
            seen = np.zeros(len(place), bool)
            seen[np.unique(name[place[hot]], return_index=True)[1]] = True
            hot = hot[~hit[hot] | seen[: len(hot)]]
            sums, inverse = _prefix_sums(self.text)
            spot = place[hot]
            first = (sums[spot + self.length] - sums[spot]) * inverse[spot]
            middle = spot + self.length // 2
            second = (sums[middle] - sums[spot]) * inverse[spot]
            at = spot - self.begins[row[hot]] + self.column("start")[row[hot]]
            yield self._batch(row[hot], at, at + self.length, mix(first), mix(second))

    def _batch(self, row, start, end, w1, w2) -> pa.RecordBatch:
        none = pa.nulls(len(row), pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.column("id")[row]), pa.array(self.column("h")[row]), pa.array(start), pa.array(end),
                none if w1 is None else pa.array(w1.view(np.int64)), none if w2 is None else pa.array(w2.view(np.int64)),
            ],
            ["id", "h", "start", "end", "w1", "w2"],
        )


def _blocks(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            block = batch.column("block").to_numpy()
            edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if held and block[a] != current:
                    yield from _Block(held, length).rows()
                    held = []
                current = block[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from _Block(held, length).rows()

    return run


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The contents of the wanted segments of each text."""
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        wanted = batch.column("wanted")
        flat = wanted.flatten()
        row = np.repeat(np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy()))
        start, size = flat.field("start").to_numpy(), flat.field("size").to_numpy().astype(np.int64)
        ids, hashes = batch.column("id"), batch.column("h")
        step = 4096
        for a in range(0, len(row), step):
            b = slice(a, a + step)
            content = data[ragged(offsets[row[b]] + start[b], size[b])]
            ends = np.concatenate([[0], np.cumsum(size[b])]).astype(np.int32)
            n = len(ends) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    flat.field("v").slice(a, n), ids.take(pa.array(row[b])), hashes.take(pa.array(row[b])),
                    pa.array(start[b]), pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(content)]),
                ],
                ["v", "id", "h", "start", "content"],
            )


# --- the job -----------------------------------------------------------------------------------


def _prefix(docs: DataFrame) -> str:
    """What no column of ``docs`` begins with."""
    taken = [c.lower() for c in docs.columns]
    mark = "__"
    while any(c.startswith(mark) for c in taken):
        mark += "_"
    return mark


def _named(docs: DataFrame, id_col: str, text_col: str, mark: str) -> DataFrame:
    """``docs`` with a name for each row: id and text hash. Rows of one name are the same text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    name = F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID))
    return docs.withColumns({f"{mark}id": name, f"{mark}h": F.xxhash64(text), f"{mark}text": text})


def repeated_ranges(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
    block_bytes: int = BLOCK_BYTES, hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """(id, h, ranges): for texts with repeated strings, the byte ranges (start, end) they cover.

    Ranges may overlap. ``id`` is the row's id (the least long for null), ``h`` its text's hash.
    """
    mark = _prefix(docs)
    texts = _named(docs, id_col, text_col, mark).select(*[F.col(mark + c).alias(c) for c in ("id", "h", "text")])
    cut = texts.where(F.octet_length("text") >= length).mapInArrow(
        _segment_rows(length, gram), "v long, c long, id long, h long, start long, size int, turns boolean"
    )
    cut = materialize(cut, "segments")
    met = cut.groupBy("v").agg(F.count("*").alias("n"), F.bool_or("turns").alias("turns"))
    met = met.where("n > 1 or turns").select("v")
    shared = materialize(cut.join(met, "v"), "shared")
    contents = shared.groupBy("v", "c").agg(
        F.count("*").alias("n"), F.min(F.struct("id", "h", "start", "size")).alias("one"),
        F.bool_or("turns").alias("turns"),
    )
    contents = materialize(contents, "contents")
    copied = shared.join(contents.where("n > 1").select("v", "c"), ["v", "c"]).select(
        "id", "h", "start", (F.col("start") + F.col("size")).alias("end")
    )
    groups = contents.groupBy("v").agg(
        F.count("*").alias("m"), F.sum("one.size").alias("bytes"), F.bool_or("turns").alias("turns")
    )
    groups = groups.where("m > 1 or turns").select("v", "bytes")
    groups = materialize(groups, "groups")
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.coalesce(F.max("bytes"), F.lit(0)).alias("most")).first()
    found = _search(texts, contents, groups, total.bytes, length, block_bytes, hot_bytes)
    ranges = copied.union(found.where("w1 is null").select("id", "h", "start", "end"))
    if total.most > hot_bytes:
        windows = found.where("w1 is not null")
        again = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").select("w1", "w2")
        ranges = ranges.union(windows.join(again, ["w1", "w2"]).select("id", "h", "start", "end"))
    return ranges.groupBy("id", "h").agg(F.collect_set(F.struct("start", "end")).alias("ranges"))


def _search(texts, contents, groups, total: int, length: int, block_bytes: int, hot_bytes: int) -> DataFrame:
    """One row per run of repeated windows of a segment, and one per window of hot minimizers."""
    blocks = max(1, math.ceil(total / block_bytes))
    tasks = max(parallelism(texts.sparkSession), min(blocks, MAX_TASKS))  # counted, so that none are merged
    hot = F.col("bytes") > hot_bytes
    salt = F.pmod(F.xxhash64("id", "h", "start"), F.ceil(F.col("bytes") / (hot_bytes // 2)))
    block = F.when(hot, F.xxhash64("v", salt)).otherwise(F.pmod(F.xxhash64("v"), F.lit(blocks)))
    wanted = contents.join(groups, "v").select("v", "one.*").groupBy("id", "h").agg(
        F.collect_list(F.struct("v", "start", "size")).alias("wanted")
    )
    fetched = texts.join(wanted, ["id", "h"]).select("id", "h", "text", "wanted").mapInArrow(
        _fetch, "v long, id long, h long, start long, content binary"
    )
    dealt = (
        fetched.join(groups.select("v", "bytes"), "v")
        .select(block.alias("block"), "id", "h", "start", hot.alias("hot"), "content")
        .repartition(tasks, "block").sortWithinPartitions("block")
    )
    found = dealt.mapInArrow(_blocks(length), "id long, h long, start long, end long, w1 long, w2 long")
    return materialize(found, "found")


def _merged(ranges: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs; neighbours that touch are one."""
    out: list[list[int]] = []
    for start, end in sorted((r["start"], r["end"]) for r in ranges or ()):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *[e for s in spans for e in s], len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def _with_ranges(docs: DataFrame, id_col: str, text_col: str, **options) -> tuple[DataFrame, str]:
    """``docs`` with columns id, h, text and ranges, and the prefix that their names have."""
    mark = _prefix(docs)
    ranges = repeated_ranges(docs, id_col=id_col, text_col=text_col, **options)
    ranges = ranges.select(*[F.col(c).alias(mark + c) for c in ("id", "h", "ranges")])
    return _named(docs, id_col, text_col, mark).join(ranges, [f"{mark}id", f"{mark}h"], "left"), mark


def removal_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, text of every row.

    ``text`` is what is left; where a cut parts a character, the bytes left of it are not in it.

    Every byte covered by a string of ``length`` bytes that starts anywhere else too is removed,
    judged on the input. Null and empty texts have no bytes. Rows with null or equal ids are texts
    like others: of two equal rows each repeats the other. Other columns may have any names; an
    empty table gives an empty one.
    """
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, str, str]] = []
            texts, ranges = batch.column("text"), batch.column("ranges").to_pylist()
            for text, own in zip(texts, ranges, strict=True):
                data, spans = text.as_buffer().to_pybytes(), _merged(own)
                kept = _kept(data, spans)
                out.append((
                    len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                    kept.decode(errors="ignore"),
                ))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"],
            )

    joined, mark = _with_ranges(docs, id_col, text_col, **options)
    joined = joined.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(f"{mark}text").alias("text"), F.col(f"{mark}ranges").alias("ranges")
    )
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the repeated strings cut out of ``text_col``; all rows and columns stay.

    Where a cut parts a character, the bytes left of it go too. Null stays null, an empty table
    empty. Of rows that repeat id and text each repeats the other; columns may have any names.
    """
    columns = docs.columns
    at = columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranges = batch.column(len(columns))
            own = batch.select(columns)
            hit = np.flatnonzero(ranges.is_valid().to_numpy(zero_copy_only=False)).tolist()
            if hit:
                texts = own.column(at).to_pylist()
                for row in hit:
                    kept = _kept(texts[row].encode(), _merged(ranges[row].as_py()))
                    texts[row] = kept.decode(errors="ignore")
                arrays = own.columns
                arrays[at] = pa.array(texts, own.column(at).type)
                own = pa.RecordBatch.from_arrays(arrays, schema=own.schema)
            yield own

    joined, mark = _with_ranges(docs, id_col, text_col, **options)
    joined = joined.select(*columns, f"{mark}ranges")
    return joined.mapInArrow(run, docs.schema)
