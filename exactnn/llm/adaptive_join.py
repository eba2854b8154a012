"""Jaccard join of word n-gram sets by adaptive multi-match prefixes.

Shingles have one global order, rare ones first. Two sets that reach the limit share at least l of
the first |x| - a(x) + l shingles of each, where a(x) is the least overlap that x allows; l is free.
A text whose prefix holds frequent shingles takes a larger l: a longer prefix, but a partner has to
match more of it before the sets are compared. Two texts meet under the smaller of their l.

* Texts of one set are a class; only classes have prefixes, links and components.
* The order comes from counters of fixed size, counted over all texts in the scan that makes the
  classes: what lies well above a counter's average load is frequent. Any fixed order is right; this
  one keeps common lines and passages out of prefixes.
* Prefixes are sent packed, by ranges of hashes. A range passes on only shingles of two classes or
  more, and forgets in between what it has passed on, so it holds no bucket.
* In a bucket of few classes all pairs meet; their matches are counted over these buckets.
* In a bucket of many, as a group of near copies has, pairs are not counted: classes carry a bitmap
  of their set, whose differing bits bound the overlap from above. Cells of bounded size are screened
  by that bound, and only pairs that may link leave them: first the likeliest of each class, again
  once those are joined, then all pairs of two components.
* Pairs are compared on full sets, the likeliest of each class first. What is in one component by
  then needs no comparison. No pair of two components is passed over.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from exactnn.llm.arrow import id_and_text, mix, slices, text_buffer
from exactnn.llm.components import connected_components
from exactnn.llm.odd_minhash import shingle_sets
from exactnn.session import MIB, materialize

SHINGLE_WORDS, LEAST = 5, 80
#: Matches asked for at most.
MOST_MATCHES = 8
#: Cost of comparing one shingle of two sets, in prefix shingles sent.
COMPARE = 0.02
#: Texts that a rare shingle is taken to meet.
RARE_MEETS = 0.25
#: Parts of the counters, and tasks whose counters one task adds up.
PARTS, FAN_IN = 256, 512
#: Partners of each text in the first round.
PARTNERS = 2
#: Bits of a set's bitmap.
LEAST_BITS, MOST_BITS = 1 << 11, 1 << 13


class Limits(NamedTuple):
    """Sizes that bound memory; none of them changes a result."""

    #: Counters of the order.
    counters: int = 1 << 22
    #: Prefix shingles of a range, those a task packs at once, and those a range holds at once.
    range_shingles: int = 1 << 18
    pack_shingles: int = 1 << 18
    held_shingles: int = 1 << 19
    #: Classes a task remembers to have sent; forgetting one only sends it again.
    seen_classes: int = 200_000
    #: Texts of a cell of the first round, and on a side of a cell of the second.
    cell: int = 512
    grid: int = 1024
    #: Keys of texts to compare that are broadcast.
    broadcast_bytes: int = 32 * MIB
    #: Classes of a bucket up to which its pairs are counted.
    counted: int = 32


# --- classes and order -----------------------------------------------------------------------------


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, k1, k2 (a hash of the text) and text."""
    return id_and_text(docs, id_col, text_col).select(
        "doc_id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(3), "text").alias("k2"), "text"
    )


def _sets_of(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, set) of a batch."""
    data, offsets = text_buffer(batch.column("text"))
    row = 0
    for first, last in slices(offsets):
        for own in shingle_sets(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], words):
            yield row, own
            row += 1


def _class_of(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


class _Seen:
    """Classes met lately."""

    def __init__(self, limit: int):
        self._names: set[bytes] = set()
        self._limit = limit

    def new(self, name: bytes) -> bool:
        if name in self._names:
            return False
        if len(self._names) >= self._limit:
            self._names.clear()
        self._names.add(name)
        return True


_SCANNED = ["doc_id", "k1", "k2", "n_shingles", "c1", "c2", "part", "counters"]


def _scan(words: int, limits: Limits):
    """A row for each text, then the task's counters by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, seen = np.zeros(limits.counters, np.uint32), _Seen(limits.seen_classes)
        for batch in batches:
            size, name = [], []
            for _, own in _sets_of(batch, words):
                size.append(len(own))
                name.append(_class_of(own))
                if len(own) and seen.new(name[-1]):
                    np.add.at(counters, (own & np.uint64(limits.counters - 1)).astype(np.int64), np.uint32(1))
            n = batch.num_rows
            halves = np.frombuffer(b"".join(name), "<i8").reshape(n, 2)
            empty = np.array(size, np.int64) == 0
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("doc_id", "k1", "k2")], pa.array(size, pa.int64()),
                    *[pa.array(np.ascontiguousarray(halves[:, i]), mask=empty) for i in (0, 1)],
                    pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
                ],
                _SCANNED,
            )
        packed = [zlib.compress(c.astype("<u8").tobytes(), 1) for c in counters.reshape(PARTS, -1)]
        none = [pa.nulls(PARTS, pa.int64()) for _ in _SCANNED[:-2]]
        yield pa.RecordBatch.from_arrays(
            [*none, pa.array(range(PARTS), pa.int32()), pa.array(packed, pa.binary())],
            _SCANNED,
        )

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the counters of one (part, salt) after another."""

    def row(key, total) -> pa.RecordBatch:
        packed = zlib.compress(total.tobytes(), 1)
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([packed], pa.binary())], ["part", "counters"])

    current, total = None, None
    for batch in batches:
        for part, salt, raw in zip(*[batch.column(c).to_pylist() for c in ("part", "salt", "counters")], strict=True):
            own = np.frombuffer(zlib.decompress(raw), "<u8")
            if (part, salt) == current:
                total = total + own
            else:
                if current is not None:
                    yield row(current, total)
                current, total = (part, salt), own
    if current is not None:
        yield row(current, total)


def shingle_counters(scanned: DataFrame, counters: int) -> np.ndarray:
    """``counters`` counts of shingles by the low bits of their hashes, over all texts."""
    sums = scanned.where("part is not null").select("part", "counters")
    tasks = sums.rdd.getNumPartitions()
    for salts in ([math.ceil(tasks / FAN_IN)] if tasks > FAN_IN else []) + [1]:
        dealt = sums.select("part", F.pmod(F.spark_partition_id(), F.lit(salts)).cast("int").alias("salt"), "counters")
        sums = dealt.repartition("part", "salt").sortWithinPartitions("part", "salt").mapInArrow(_added, "part int, counters binary")
    found = np.zeros((PARTS, counters // PARTS), np.int64)
    for r in sums.collect():
        found[r.part] = np.frombuffer(zlib.decompress(r.counters), "<u8")
    return found.ravel()


def rarity(counters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A code for each counter, 0 for rare shingles, and how many further texts a code stands for."""
    load = float(counters.mean()) if counters.size else 0.0
    over = counters / (2 * load + 8)
    codes = np.where(over > 1, np.ceil(2 * np.log2(np.maximum(over, 1))), 0).astype(np.uint8)
    further = (2 * load + 8) * 2.0 ** (np.arange(256) / 2)
    further[0] = RARE_MEETS
    return codes, further


# --- prefixes --------------------------------------------------------------------------------------


def adaptive_prefix(own: np.ndarray, codes: np.ndarray, further: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, int]:
    """The prefix of a set, in the global order, and how many matches it asks for.

    The cost of l matches: the prefix's shingles, the texts that they are estimated to meet, and
    comparing those that can have l of them.
    """
    n = len(own)
    needed = (least * n + 99) // 100
    spare = n - needed
    code = codes[(own & np.uint64(len(codes) - 1)).astype(np.int64)]
    if code.any():
        order = np.argsort(code, kind="stable")  # the set is in the order of its hashes
        own, code = own[order], code[order]
    most = min(MOST_MATCHES, needed)
    met = np.cumsum(further[code[: spare + most]])[spare:]
    matches = np.arange(1, most + 1)
    cost = spare + matches + met * (1 + COMPARE * n / matches)
    best = int(np.argmin(cost)) + 1
    return own[: spare + best], best


class _Pack:
    """Prefixes of many classes, to be sent by range."""

    def __init__(self, ranges: int):
        self._ranges = np.uint64(ranges)
        self.clear()

    def clear(self) -> None:
        self.count, self.tokens, self.lams = 0, [], []
        self.names, self.sizes, self.ls = [], [], []

    def add(self, name: bytes, size: int, tokens: np.ndarray, l: int, spare: int) -> None:  # noqa: E741
        self.names.append(name), self.sizes.append(size), self.ls.append(l)
        self.tokens.append(tokens)
        self.lams.append(np.maximum(np.arange(1, len(tokens) + 1) - spare, 1).astype(np.uint8))
        self.count += len(tokens)

    def rows(self) -> pa.RecordBatch:
        tokens, lams = np.concatenate(self.tokens), np.concatenate(self.lams)
        owner = np.repeat(np.arange(len(self.names)), [len(t) for t in self.tokens])
        # prefixes hold the least hashes of each set, so ranges are those of another hash
        part = ((mix(tokens) >> np.uint64(32)) * self._ranges >> np.uint64(32)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part, tokens, lams, owner = part[order], tokens[order], lams[order], owner[order]
        names = np.array(self.names, "V16")
        sizes, ls = np.array(self.sizes, "<u4"), np.array(self.ls, np.uint8)
        edges = np.flatnonzero(np.append(True, part[1:] != part[:-1])).tolist() + [len(part)]
        columns: list[list] = [[] for _ in range(7)]
        for a, b in zip(edges, edges[1:], strict=False):
            used, place = np.unique(owner[a:b], return_inverse=True)
            for column, value in zip(columns, (
                int(part[a]), tokens[a:b].astype("<u8").tobytes(), lams[a:b].tobytes(), place.astype("<u4").tobytes(),
                names[used].tobytes(), sizes[used].tobytes(), ls[used].tobytes(),
            ), strict=True):
                column.append(value)
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]], _PACKED
        )


_PACKED = ["part", "tokens", "lams", "owners", "names", "sizes", "ls"]
_ENTRY = np.dtype([("token", "<u8"), ("c1", "<i8"), ("c2", "<i8"), ("size", "<i4"), ("l", "i1"), ("lam", "i1")])


def _prefixes(words: int, least: int, ranges: int, order, limits: Limits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, further = order.value
        pack, seen = _Pack(ranges), _Seen(limits.seen_classes)
        for batch in batches:
            for _, own in _sets_of(batch, words):
                if not len(own):
                    continue
                name = _class_of(own)
                if not seen.new(name):
                    continue
                tokens, l = adaptive_prefix(own, codes, further, least)  # noqa: E741
                pack.add(name, len(own), tokens, l, len(own) - (least * len(own) + 99) // 100)
                if pack.count >= limits.pack_shingles:
                    yield pack.rows()
                    pack.clear()
        if pack.count:
            yield pack.rows()

    return run


def _entries(batch: pa.RecordBatch, row: int) -> np.ndarray:
    raw = lambda name, kind: np.frombuffer(batch.column(name)[row].as_buffer(), kind)
    tokens, owner = raw("tokens", "<u8"), raw("owners", "<u4")
    names = raw("names", "<i8").reshape(-1, 2)
    out = np.empty(len(tokens), _ENTRY)
    out["token"], out["lam"] = tokens, raw("lams", np.uint8)
    out["c1"], out["c2"] = names[owner, 0], names[owner, 1]
    out["size"], out["l"] = raw("sizes", "<u4")[owner], raw("ls", np.uint8)[owner]
    return out


def _shared(limit: int):
    """Entries of shingles that two classes or more have in their prefixes, of one range after another."""

    def settle(held: list[np.ndarray], known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(entries to pass on, entries still alone, shingles passed on)."""
        every = np.concatenate(held)
        every = every[np.lexsort((every["c2"], every["c1"], every["token"]))]
        new = np.ones(len(every), bool)
        new[1:] = (every["token"][1:] != every["token"][:-1]) | (every["c1"][1:] != every["c1"][:-1]) | (every["c2"][1:] != every["c2"][:-1])
        every = every[new]
        heads = np.flatnonzero(np.append(True, every["token"][1:] != every["token"][:-1]))
        sizes = np.diff(np.append(heads, len(every)))
        tokens = every["token"][heads]
        passed = (sizes > 1) | np.isin(tokens, known, assume_unique=True)
        go = np.repeat(passed, sizes)
        return every[go], every[~go], np.union1d(known, tokens[passed])

    def rows(found: np.ndarray) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
        columns = [np.ascontiguousarray(found["token"]).view(np.int64), *[found[c] for c in ("c1", "c2", "size", "l", "lam")]]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(c)).cast(k) for c, k in zip(columns, kinds, strict=True)], ["token", "c1", "c2", "size", "l", "lam"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, count, known = None, [], 0, np.zeros(0, "<u8")
        for batch in batches:
            for row, part in enumerate(batch.column("part").to_pylist()):
                if part != current:
                    if held:
                        yield rows(settle(held, known)[0])
                    current, held, count, known, full = part, [], 0, np.zeros(0, "<u8"), limit
                held.append(_entries(batch, row))
                count += len(held[-1])
                if count > full:
                    found, alone, known = settle(held, known)
                    yield rows(found)
                    held, count = [alone], len(alone)
                    full = max(limit, 2 * count)  # so that each entry is sorted a few times at most
        if held:
            yield rows(settle(held, known)[0])

    return run


# --- large buckets ---------------------------------------------------------------------------------


def bitmap(own: np.ndarray) -> bytes:
    """A bit for each shingle by its hash; shingles may share one. Longer bitmaps fold onto shorter ones."""
    width = min(max(LEAST_BITS, 1 << (2 * len(own) - 1).bit_length()), MOST_BITS)
    bits = np.zeros(width, np.uint8)
    bits[((own >> np.uint64(32)) & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def _bitmaps(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = [bitmap(own) for _, own in _sets_of(batch, words)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(maps, pa.binary())], ["id", "bits"])

    return run


class _Cell:
    """Classes of one bucket, with their bitmaps."""

    def __init__(self, rows: pa.Table):
        self.id, self.component, self.size, self.l, self.lam = (rows[c].to_numpy() for c in ("id", "component", "size", "l", "lam"))
        self._bits = rows["bits"].to_pylist()
        self._widths = np.array([8 * len(b) for b in self._bits])

    def widths(self) -> list[int]:
        return np.unique(self._widths).tolist()

    def of_width(self, width: int) -> np.ndarray:
        return np.flatnonzero(self._widths == width)

    def bits(self, rows: np.ndarray, width: int) -> np.ndarray:
        """Bitmaps of rows of one width, folded to ``width``, as 0 and 1."""
        raw = np.frombuffer(b"".join([self._bits[i] for i in rows.tolist()]), np.uint8).reshape(len(rows), -1, width // 8)
        return np.unpackbits(np.bitwise_or.reduce(raw, axis=1), axis=1).astype(np.float32)


def screened(left: _Cell, right: _Cell, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows of left, rows of right, likeness), -1 for pairs that cannot link or are of one component.

    A bit that only one set has stands for a shingle that the other lacks. So the overlap is at most
    the bits in common and the shingles that a set has beyond its bits.
    """
    for w in left.widths():
        for v in right.widths():
            if max(w, v) * least >= 200 * min(w, v):
                continue  # a bitmap has 2 to 4 bits a shingle, so sizes are too far apart
            i, j = left.of_width(w), right.of_width(v)
            x, y = left.bits(i, min(w, v)), right.bits(j, min(w, v))
            n, m = left.size[i].astype(np.int64), right.size[j].astype(np.int64)
            beyond = np.minimum.outer(n - x.sum(1).astype(np.int64), m - y.sum(1).astype(np.int64))
            common = (x @ y.T).astype(np.int64) + beyond
            union = np.add.outer(n, m) - common
            may = (100 * common >= least * union) & (left.component[i][:, None] != right.component[j][None, :])
            may &= np.maximum.outer(left.lam[i], right.lam[j]) <= np.minimum.outer(left.l[i], right.l[j])
            yield i, j, np.where(may, common / union, -1.0)


def _cells(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of one key after another."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        by = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in keys])
        edges = [0, *(np.flatnonzero((by[:, 1:] != by[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            key = tuple(by[:, a].tolist())
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _found(a: np.ndarray, b: np.ndarray, likeness: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (a, b, likeness)], ["a", "b", "likeness"])


def _likeliest_of(least: int):
    """(class, its likeliest partner in a cell that is of another component, likeness)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _cells(batches, ["token", "cell"]):
            cell = _Cell(rows)
            best, partner = np.full(len(cell.id), -1.0), np.zeros(len(cell.id), np.int64)
            for i, j, likeness in screened(cell, cell, least):
                at = likeness.argmax(1)
                value = likeness[np.arange(len(i)), at]
                more = value > best[i]
                best[i[more]], partner[i[more]] = value[more], cell.id[j[at[more]]]
            has = best > 0
            yield _found(cell.id[has], partner[has], best[has])

    return run


def _may_link(least: int):
    """All pairs of a left and a right row of a cell that may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _cells(batches, ["token", "t", "u"]):
            side = rows["side"].to_numpy()
            left, right = (_Cell(rows.filter(pa.array(side == k))) for k in (0, 1))
            largest = rows["largest"][0].as_py()
            for i, j, likeness in screened(left, right, least):
                once = (right.component[j] == largest)[None, :] | (left.id[i][:, None] < right.id[j][None, :])
                p, q = np.nonzero((likeness > 0) & once)
                yield _found(left.id[i[p]], right.id[j[q]], likeness[p, q])

    return run


# --- comparing -------------------------------------------------------------------------------------


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [own.tobytes() for _, own in _sets_of(batch, words)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sets, pa.binary())], ["id", "shingles"])

    return run


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for row in range(batch.num_rows):
            p, q = (np.frombuffer(batch.column(c)[row].as_buffer(), np.uint64) for c in ("x", "y"))
            at = np.minimum(np.searchsorted(q, p), len(q) - 1)
            found.append(int((q[at] == p).sum()))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.int64())], ["a", "b", "common"])


def _confirmed(pairs: DataFrame, sets: DataFrame, sizes: DataFrame, least: int) -> DataFrame:
    """(a, b, common) of the pairs of ids that reach the limit on their full sets."""
    for side, own in (("a", "x"), ("b", "y")):
        pairs = pairs.join(sets.select(F.col("id").alias(side), F.col("shingles").alias(own)), side)
    found = pairs.select("a", "b", "x", "y").mapInArrow(_common, "a long, b long, common long")
    for side in ("a", "b"):
        found = found.join(sizes.select(F.col("id").alias(side), F.col("n_shingles").alias(f"n_{side}")), side)
    linked = F.col("common") * 100 >= F.lit(least) * (F.col("n_a") + F.col("n_b") - F.col("common"))
    return found.where(linked).select("a", "b", "common")


def _alike(left: str, right: str, least: int) -> Column:
    """Whether sizes allow a link."""
    return F.least(left, right) * 100 >= F.greatest(left, right) * least


def _slot(parts: Column, *by) -> Column:
    return F.pmod(F.xxhash64(*by), parts).cast("int")


class _Join:
    """The tables of one join: rows by class, classes, prefix entries of shared shingles."""

    def __init__(self, docs: DataFrame, words: int, least: int, id_col: str, text_col: str, limits: Limits = Limits()):
        spark = docs.sparkSession
        self.least, self.limits = least, limits
        rows = _keyed(docs, id_col, text_col)
        schema = "doc_id long, k1 long, k2 long, n_shingles long, c1 long, c2 long, part int, counters binary"
        scanned = materialize(rows.mapInArrow(_scan(words, limits), schema), "scanned")
        self.rows = scanned.where("part is null").drop("part", "counters")
        named = self.rows.where("c1 is not null and doc_id is not null")
        classes = named.groupBy("c1", "c2").agg(F.min(F.struct("doc_id", "k1", "k2")).alias("first"), F.max("n_shingles").alias("n_shingles"))
        self.classes = materialize(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
        total = self.classes.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("n")).first().n
        ranges = max(1, math.ceil(total * (100 - least) / 100 / limits.range_shingles))
        order = spark.sparkContext.broadcast(rarity(shingle_counters(scanned, limits.counters)))
        packed = rows.where("doc_id is not null").select("text").mapInArrow(
            _prefixes(words, least, ranges, order, limits), "part long, tokens binary, lams binary, owners binary, names binary, sizes binary, ls binary"
        )
        shared = packed.repartition("part").sortWithinPartitions("part").mapInArrow(
            _shared(limits.held_shingles), "token long, c1 long, c2 long, size int, l int, lam int"
        )
        ids = self.classes.select("id", "c1", "c2")
        # joined first, so that what was sent twice is dropped without a further shuffle
        shared = shared.join(ids, ["c1", "c2"]).dropDuplicates(["c1", "c2", "token"])
        self.entries = materialize(shared.drop("c1", "c2"), "entries")
        self._texts, self._words = rows, words
        filled = self.entries.groupBy("token").agg(F.count("*").alias("m")).where(F.col("m") > limits.counted)
        self._hot = materialize(filled, "hot")
        self._large = self._bits = None
        if self._hot.limit(1).count():
            self._large = materialize(self.entries.join(self._hot, "token"), "large")
            self._bits = self._read(self._large.select("id").distinct(), "bits", _bitmaps)

    def _full_sets(self, pairs: DataFrame) -> DataFrame:
        """(id, shingles) of the classes in ``pairs``."""
        return self._read(pairs.select("a").union(pairs.select("b")).toDF("id").distinct(), "shingles", _sets)

    def _read(self, ids: DataFrame, name: str, function) -> DataFrame:
        """(id, name) of classes, from the text of one of their rows."""
        wanted = materialize(self.classes.join(ids, "id").select("id", "first.*"), "wanted")
        n = wanted.count()
        if n * 64 <= self.limits.broadcast_bytes:
            wanted = F.broadcast(wanted)
        texts = self._texts.join(wanted, ["doc_id", "k1", "k2"]).select("id", "text")
        sets = materialize(texts.mapInArrow(function(self._words), f"id long, {name} binary"), name)
        # rows that repeat id and text give equal sets
        return sets if sets.count() == n else sets.dropDuplicates(["id"])

    def counted(self) -> DataFrame:
        """(a, b, likeness) of the pairs with enough matches in the buckets of few classes."""
        rows = self.entries if self._large is None else self.entries.join(self._hot, "token", "left_anti")
        sides = [rows.select("token", *[F.col(c).alias(f"{side}_{c}") for c in ("id", "size", "l", "lam")]) for side in "xy"]
        met = sides[0].join(sides[1], "token").where(
            (F.col("x_id") < F.col("y_id"))
            & _alike("x_size", "y_size", self.least)
            & (F.greatest("x_lam", "y_lam") <= F.least("x_l", "y_l"))
        )
        counted = met.groupBy(F.col("x_id").alias("a"), F.col("y_id").alias("b")).agg(
            F.count("*").alias("matches"), F.first(F.least("x_l", "y_l")).alias("l")
        )
        return materialize(counted.where("matches >= l").select("a", "b", F.col("matches").cast("double").alias("likeness")), "counted")

    @staticmethod
    def _placed(rows: DataFrame, joined: DataFrame | None) -> DataFrame:
        """``rows`` with the component of each class."""
        if joined is None:
            return rows.withColumn("component", F.col("id"))
        names = joined.withColumnRenamed("node", "id")
        return rows.join(names, "id", "left").withColumn("component", F.coalesce("component", "id"))

    def likeliest_of_large(self, joined: DataFrame | None) -> DataFrame:
        """(a, b) of the likeliest partners of each class in cells of the large buckets, out of its component."""
        salt = F.lit(0 if joined is None else 1)
        slot = _slot(F.ceil(F.col("m") / self.limits.cell), "id", "token", salt)
        rows = self._placed(self._large, joined).withColumn("cell", slot).join(self._bits, "id")
        cells = rows.repartition("token", "cell").sortWithinPartitions("token", "cell")
        found = cells.mapInArrow(_likeliest_of(self.least), "a long, b long, likeness double")
        best = Window.partitionBy("a").orderBy(F.desc("likeness"), "b")
        kept = found.distinct().withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= PARTNERS)
        return materialize(kept.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "likeliest")

    def meetings(self, counted: DataFrame, joined: DataFrame | None) -> DataFrame:
        """(a, b, likeness) of ``counted`` and of the pairs of large buckets, but for those of one component of ``joined``."""
        if self._large is None:
            return counted
        return counted.union(self._met_in_cells(joined)).groupBy("a", "b").agg(F.max("likeness").alias("likeness"))

    def _met_in_cells(self, joined: DataFrame | None) -> DataFrame:
        """(a, b, likeness) of the pairs of the large buckets that may link.

        A bucket is a grid of cells: its left side are the texts outside its largest component, or
        all, its right side all texts.
        """
        rows = self._placed(self._large, joined)
        sizes = rows.groupBy("token", "component").agg(F.count("*").alias("n"))
        largest = F.max_by("component", F.struct("n", "component"))
        buckets = sizes.groupBy("token").agg(F.sum("n").alias("m"), F.max("n").alias("most"), largest.alias("largest"), F.count("*").alias("parts"))
        rest = F.col("m") - F.col("most")
        buckets = buckets.where("parts > 1").select(
            "token", "largest", F.ceil(rest / self.limits.grid).cast("int").alias("ts"), F.ceil(F.col("m") / self.limits.grid).cast("int").alias("us")
        )
        rows = rows.drop("m").join(buckets, "token")
        deal = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = rows.where("component <> largest").select(
            "*", _slot(F.col("ts"), "id", F.lit(1)).alias("t"), deal("us").alias("u"), F.lit(0).alias("side")
        )
        right = rows.select("*", deal("ts").alias("t"), _slot(F.col("us"), "id", F.lit(2)).alias("u"), F.lit(1).alias("side"))
        both = left.union(right).join(self._bits, "id")
        cells = both.repartition("token", "t", "u").sortWithinPartitions("token", "t", "u")
        met = cells.mapInArrow(_may_link(self.least), "a long, b long, likeness double")
        likelier = (F.col("likeness") + 1000).alias("likeness")  # than any that is counted
        return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), likelier).distinct()

    def confirmed(self, pairs: DataFrame, name: str) -> DataFrame:
        return materialize(_confirmed(pairs, self._full_sets(pairs), self.classes, self.least), name)

    def components(self) -> DataFrame:
        """(id, component) of the classes that have links.

        Each text's likeliest pairs are compared first, as they join most of a group of copies; what
        is in one component by then needs no comparison. The last time all of what is left is compared.
        """
        counted = self.counted()
        tested = self._likeliest(counted)
        if self._large is not None:
            tested = materialize(tested.union(self.likeliest_of_large(None)).distinct(), "tested")
        joined = connected_components(self.confirmed(tested, "links"))
        if self._large is not None:
            again = materialize(self.likeliest_of_large(joined).join(tested, ["a", "b"], "left_anti"), "again")
            joined = self._joined(joined, self.confirmed(again, "links"))
            tested = tested.union(again)
        left = self.meetings(counted, joined).join(tested, ["a", "b"], "left_anti")
        for last in (False, True):
            for side in ("a", "b"):
                name = joined.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
                left = left.join(name, side, "left").withColumn(f"c_{side}", F.coalesce(f"c_{side}", side))
            left = materialize(left.where("c_a <> c_b").select("a", "b", "likeness"), "left")
            if not left.limit(1).count():
                break
            some = left.select("a", "b") if last else self._likeliest(left)
            joined = self._joined(joined, self.confirmed(some, "links"))
            left = left.join(some, ["a", "b"], "left_anti")
        return joined.withColumnRenamed("node", "id")

    @staticmethod
    def _joined(joined: DataFrame, links: DataFrame) -> DataFrame:
        """``joined`` with more links."""
        if not links.limit(1).count():
            return joined
        known = joined.select(F.col("node").alias("a"), F.col("component").alias("b"))
        return connected_components(known.union(links.select("a", "b")))

    @staticmethod
    def _likeliest(pairs: DataFrame) -> DataFrame:
        """The PARTNERS likeliest pairs of each text."""
        ends = F.explode(F.array("a", "b")).alias("end")
        best = Window.partitionBy("end").orderBy(F.desc("likeness"), "a", "b")
        ranked = pairs.select("*", ends).withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= PARTNERS)
        return materialize(ranked.select("a", "b").distinct(), "likeliest")


def ngram_components(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text",
    limits: Limits = Limits(),
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``.

    A document's set: its distinct shingles of ``shingle_words`` words (runs of bytes other than
    space and \\t..\\r, A-Z lower-cased), or the whole text if it has fewer words. Two link if 100 *
    |intersection| >= ``least`` * |union|; ``component_id`` is the smallest doc_id reachable.

    Null and empty texts and texts without words have no shingles and no links. Rows with a null id
    link with nothing and have a null component. Rows of one id are documents of their own, each
    with the component of its text; repeated rows are one set. Other columns are not looked at; of
    no rows nothing is returned. Shingles are 64-bit hashes.
    """
    job = _Join(docs, shingle_words, least, id_col, text_col, limits)
    joined = job.components()
    firsts = joined.join(job.classes.select("id", "first.doc_id"), "id")
    smallest = firsts.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    placed = job.classes.select("id", "c1", "c2", F.col("first.doc_id").alias("own")).join(joined, "id", "left")
    placed = placed.join(smallest, "component", "left").select("c1", "c2", F.coalesce("component_id", "own").alias("component_id"))
    result = job.rows.join(placed, ["c1", "c2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"))


def ngram_links(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text",
    limits: Limits = Limits(),
) -> tuple[DataFrame, DataFrame]:
    """All links, as pairs of classes of equal sets, and the members of the classes.

    (a_id, b_id, common) with a_id < b_id the classes' numbers, and (class_id, doc_id, n_shingles) of
    every row with words and an id. The rest is as :func:`ngram_components` has it.
    """
    job = _Join(docs, shingle_words, least, id_col, text_col, limits)
    links = job.confirmed(job.meetings(job.counted(), None).select("a", "b"), "links").select(F.col("a").alias("a_id"), F.col("b").alias("b_id"), "common")
    members = job.rows.where("doc_id is not null").join(job.classes.select("c1", "c2", F.col("id").alias("class_id")), ["c1", "c2"])
    return links, members.select("class_id", "doc_id", "n_shingles")
