"""Near-duplicates: banded MinHash, odd sketches to screen candidates, full sets to confirm.

* Texts with the same shingle set form a class at once. Classes are numbered; from there on a
  class, not a document, is what has sketches, is linked and has a component.
* The MinHash samples of a set make band keys, and, folded into a bitmap by parity, its odd
  sketch. Two sketches differ in about as many bits as samples differ, so that the population
  count of their XOR tells high similarities apart.
* Buckets of one band key are cut into cells of bounded size. Inside a cell the sketches propose
  a spanning forest: the likeliest links first, none between texts already joined. So a large
  group of copies costs as many pairs as it has texts.
* Proposed pairs are confirmed on full shingle sets; confirmed links give components.
* What is left in a bucket outside its largest component then meets all members of the bucket
  that it is not joined with, in a grid of cells. No link between components is lost to the cells.
  Few such meetings are returned as pairs and confirmed like the others. Where they are many, as
  in a large group of copies with stragglers, the full sets go into the cells and only confirmed
  links leave them, one for each two components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exactnn.llm.arrow import (
    id_and_text,
    mix,
    ragged,
    seeds,
    slices,
    span_hashes,
    text_buffer,
    whitespace_words,
)
from exactnn.llm.components import connected_components
from exactnn.session import materialize

#: Words of a shingle by default, and at most.
SHINGLE_WORDS, MOST_WORDS = 5, 64
#: A pair at 0.8 shares no key in one of 2 * 10**7 cases: (1 - 0.8**4)**32.
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 1024
#: Links have 100 * intersection >= LEAST * union.
LEAST = 80
#: Standard deviations of the estimate that a screened pair may lie below the limit.
SLACK = 6.0
#: Texts in a cell of the first round, and on either side of a cell of the second.
CELL = 512
LEFT_CELL, RIGHT_CELL = 512, 2048
#: Meetings of a bucket up to which they are returned as pairs.
FEW_PAIRS = 1000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FACTORS = seeds(SAMPLES, 11) | np.uint64(1)
_PLACES = seeds(MOST_WORDS, 12) | np.uint64(1)
_SAMPLE_SALT = seeds(SAMPLES, 13)
_BAND_SALT = seeds(BANDS, 14)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles of ``size`` words.

    A text of fewer words is one shingle, one without words none.
    """
    data = _LOWER[data]
    starts, ends, counts = whitespace_words(data, offsets)
    words = span_hashes(data, starts, ends)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    shingles = sum(padded[i : i + len(words)] * _PLACES[i] for i in range(size))
    shingles = mix(shingles + np.uint64(size)) if len(words) else words
    first = np.cumsum(counts) - counts
    for at, n in zip(first.tolist(), counts.tolist(), strict=True):
        if n >= size:
            yield np.unique(shingles[at : at + n - size + 1])
        elif n:
            whole = (words[at : at + n] * _PLACES[:n]).sum(dtype=np.uint64) + np.uint64(n)
            yield mix(np.array([whole], np.uint64))
        else:
            yield words[:0]


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    """SAMPLES minima over a non-empty set, in steps of bounded memory."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(shingles), 1024):
        part = _FACTORS[:, None] * shingles[a : a + 1024]
        np.minimum(least, part.min(axis=1), out=least)
    return least


def odd_sketch(samples: np.ndarray) -> bytes:
    """Parities of the samples' places in a bitmap."""
    at = (mix(samples + _SAMPLE_SALT) % np.uint64(SKETCH_BITS)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=SKETCH_BITS) & 1).tobytes()


def band_keys(samples: np.ndarray) -> np.ndarray:
    key = _BAND_SALT.copy()
    for row in samples.reshape(BANDS, ROWS).T:
        key = mix(key ^ row) * np.uint64(0x9E3779B97F4A7C15)
    return key


def most_bits(least: int = LEAST, slack: float = SLACK) -> int:
    """Differing bits up to which two sketches can be of sets at the limit of similarity.

    At similarity s the differing samples are binomial; each sets or clears two of the bits, and
    random places of bits add their own spread.
    """
    share = 1 - least / 100
    differ = SAMPLES * share + slack * np.sqrt(SAMPLES * share * (1 - share))
    places = 2 * min(differ, SAMPLES)
    bits = SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** places)
    return int(np.ceil(bits + slack * np.sqrt(places * places / SKETCH_BITS / 4 + 1)))


def _signatures(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            size, name, sketch, keys = [], [], [], []
            for first, last in slices(offsets):
                texts = offsets[first : last + 1] - offsets[first]
                for own in shingle_sets(data[offsets[first] : offsets[last]], texts, words):
                    size.append(len(own))
                    if not len(own):
                        name.append(None), sketch.append(None), keys.append(None)
                        continue
                    samples = min_hashes(own)
                    name.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                    sketch.append(odd_sketch(samples))
                    keys.append(band_keys(samples).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("row_key"), pa.array(size, pa.int64()),
                    pa.array(name, pa.binary()), pa.array(sketch, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                ],
                ["doc_id", "row_key", "n_shingles", "class", "sketch", "keys"],
            )

    schema = "doc_id long, row_key binary, n_shingles long, class binary, sketch binary, keys array<long>"
    return docs.mapInArrow(run, schema)


def _grouped(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[list[dict]]:
    """Batches of one key after another, from rows in key order: (key changes only between them)."""
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in key]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            if b > a:
                yield tuple(c[a].item() for c in columns), batch.slice(a, b - a)


class _Texts:
    """Ids (numbers of classes), components, sizes, sketches and keys of rows of a bucket."""

    def __init__(self, batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches)
        self.id = table.column("id").to_numpy()
        self.component = table.column("component").to_numpy()
        self.size = table.column("n_shingles").to_numpy()
        raw = b"".join(table.column("sketch").to_pylist())
        self.sketch = np.frombuffer(raw, np.uint64).reshape(len(self.id), -1)
        self.sets = None
        if "shingles" in table.column_names:
            self.sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
        self.keys = None
        if "keys" in table.column_names:
            self.keys = table.column("keys").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)


def _near(left: _Texts, right: _Texts, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(left, right, differing bits) of pairs of two components that pass size and sketch."""
    step = max(1, (1 << 16) // max(1, len(left.id)))
    for a in range(0, len(right.id), step):
        b = slice(a, a + step)
        apart = left.component[:, None] != right.component[b]
        low = np.minimum(left.size[:, None], right.size[b])
        apart &= 100 * low >= LEAST * np.maximum(left.size[:, None], right.size[b])
        i, j = np.nonzero(apart)
        j = j + a
        bits = np.bitwise_count(left.sketch[i] ^ right.sketch[j]).sum(axis=1, dtype=np.int64)
        good = bits <= limit
        yield i[good], j[good], bits[good]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a spanning forest of each cell, by differing bits: Kruskal's order."""
    limit = most_bits()
    held: list[pa.RecordBatch] = []
    current = None
    found: list[tuple[int, int]] = []

    def close() -> None:
        if len(held) and sum(b.num_rows for b in held) > 1:
            found.extend(_spanning(_Texts(held), limit))

    for key, part in _grouped(batches, ["bucket", "cell"]):
        if key != current:
            close()
            held, current = [], key
            if len(found) > 10_000:
                yield _pairs(found)
                found = []
        held.append(part)
    close()
    yield _pairs(found)


def _spanning(texts: _Texts, limit: int) -> list[tuple[int, int]]:
    parts = list(_near(texts, texts, limit))
    i, j, bits = (np.concatenate(x) for x in zip(*parts, strict=True))
    half = i < j
    i, j, bits = i[half], j[half], bits[half]
    order = np.argsort(bits, kind="stable")
    parent = list(range(len(texts.id)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found, left = [], len(parent) - 1
    for x, y in zip(i[order].tolist(), j[order].tolist(), strict=True):
        a, b = root(x), root(y)
        if a != b:
            parent[a] = b
            found.append((int(texts.id[x]), int(texts.id[y])))
            left -= 1
            if not left:
                break
    return found


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a = np.array([min(p) for p in found], np.int64)
    b = np.array([max(p) for p in found], np.int64)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Texts, _Texts, np.ndarray, np.ndarray]]:
    """(left, right, i, j): pairs of a cell's left and right rows, each in its first common band.

    A cell's left rows come first and are one object for all of its right batches.
    """
    limit = most_bits()
    held: list[pa.RecordBatch] = []
    left: _Texts | None = None
    current = None
    for key, part in _grouped(batches, ["bucket", "t", "u", "side"]):
        if key[:3] != current:
            held, left, current = [], None, key[:3]
        if key[3] == 0:
            held.append(part)
            continue
        if not held:
            continue
        left = left or _Texts(held)
        right = _Texts([part])
        band = part.column("band")[0].as_py()
        for i, j, _ in _near(left, right, limit):
            if band:
                earlier = (left.keys[i, :band] == right.keys[j, :band]).any(axis=1)
                i, j = i[~earlier], j[~earlier]
            if len(i):
                yield left, right, i, j


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for left, right, i, j in _meetings(batches):
        x, y = left.id[i], right.id[j]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"]
        )


class _Postings:
    """The texts of a cell's left side by shingle, to count common shingles with all at once."""

    def __init__(self, sets: list[np.ndarray]):
        sizes = np.array([len(s) for s in sets], np.int64)
        order = np.argsort(every := np.concatenate(sets), kind="stable")
        self.owner = np.repeat(np.arange(len(sets)), sizes)[order]
        self.shingles, self.first, self.count = np.unique(every[order], return_index=True, return_counts=True)
        self.texts = len(sets)

    def common(self, own: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.shingles, own), len(self.shingles) - 1)
        at = at[self.shingles[at] == own]
        return np.bincount(self.owner[ragged(self.first[at], self.count[at])], minlength=self.texts)


def _linked_across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Confirmed links of the meetings, one of each two components in a cell."""
    current, postings, known = None, None, set()
    for left, right, i, j in _meetings(batches):
        if left is not current:
            current, postings, known = left, _Postings(left.sets), set()
        found = []
        order = np.argsort(j, kind="stable")
        i, j = i[order], j[order]
        edges = np.flatnonzero(np.append(True, j[1:] != j[:-1])).tolist() + [len(j)]
        for a, b in zip(edges, edges[1:], strict=False):
            y, component = int(j[a]), int(right.component[j[a]])
            rows = [x for x in i[a:b].tolist() if (int(left.component[x]), component) not in known]
            if not rows:
                continue
            common = postings.common(right.sets[y])
            for x in rows:
                both = int(common[x])
                if 100 * both >= LEAST * (int(left.size[x]) + int(right.size[y]) - both):
                    known.add((int(left.component[x]), component))
                    found.append((int(left.id[x]), int(right.id[y])))
        yield _pairs(found)


def _sets(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for first, last in slices(offsets):
                texts = offsets[first : last + 1] - offsets[first]
                sets = [s.tobytes() for s in shingle_sets(data[offsets[first] : offsets[last]], texts, words)]
                ids = batch.column("id").slice(first, last - first)
                yield pa.RecordBatch.from_arrays([ids, pa.array(sets, pa.binary())], ["id", "shingles"])

    return docs.mapInArrow(run, "id long, shingles binary")


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
            p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            at = np.minimum(np.searchsorted(q, p), len(q) - 1)
            common = int((q[at] == p).sum())
            rows.append(100 * common >= LEAST * (len(p) + len(q) - common))
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(rows, pa.bool_())], ["a", "b", "linked"]
        )


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, linked) of distinct pairs of ids, on the full sets."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    joined = pairs.distinct().join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return materialize(joined.mapInArrow(_confirm, "a long, b long, linked boolean"), "confirmed")


def _cell(parts, *by) -> DataFrame:
    return F.pmod(F.xxhash64(*by), parts).cast("int")


def _row_key(doc_id: Column, text: Column) -> Column:
    """A hash that is the same for rows of one id (or of none) and one text."""
    return F.unhex(F.sha2(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), text), 256))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and row_key."""
    return id_and_text(docs, id_col, text_col).withColumn("row_key", _row_key(F.col("doc_id"), F.col("text")))


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``.

    Documents are linked if 100 * |intersection| >= 80 * |union| of their sets of shingles of
    ``shingle_words`` words, or the whole text if it has fewer; A-Z are lower-cased.
    ``component_id`` is the smallest doc_id reachable over links, ``kept`` marks it. Null and empty texts and texts without words have no shingles and no links. Rows
    with a null id are linked with nothing, have a null component and are kept. Rows that share
    an id are documents of their own: each has the links and the component of its text. Repeated
    rows are in the result as often as in ``docs``. Other columns are not looked at, whatever their
    names; an empty table gives an empty one.
    """
    rows = _keyed(docs, id_col, text_col)
    signed = materialize(_signatures(rows, shingle_words), "signatures")
    names = _components(rows, signed.where("doc_id is not null"), shingle_words)
    names = names.select("class", F.col("first.doc_id").alias("component_id"))
    result = signed.select("doc_id", "n_shingles", "class").join(names, "class", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return result.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, the one of the smallest id.

    Here rows are linked whatever their ids are, also those without one, which stay only where no
    row of the group has an id. Of rows that are equal in id (or in having none) and text one
    stays, also where the text has no words. An empty table stays empty; columns may have any names.
    """
    key = "__row_key"
    while key in (c.lower() for c in docs.columns):
        key = "_" + key
    rows = _keyed(docs, id_col, text_col)
    signed = materialize(_signatures(rows, shingle_words), "signatures")
    names = _components(rows, signed, shingle_words).select("class", F.col("first.row_key").alias("stays"))
    counted = signed.groupBy("row_key", "class").agg(F.count("*").alias("n"))
    gone = F.coalesce(F.col("row_key") != F.col("stays"), F.lit(False)).alias("gone")
    marked = counted.join(names, "class", "left").select(F.col("row_key").alias(key), "n", gone)
    marked = materialize(marked.where("gone or n > 1"), "marked")
    keyed = docs.withColumn(key, _row_key(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    out = keyed.join(marked, key, "left_anti")
    repeated = marked.where("not gone")
    if repeated.limit(1).count():
        out = out.unionByName(keyed.join(repeated, key, "left_semi").dropDuplicates([key]))
    return out.drop(key)


def _components(rows: DataFrame, signed: DataFrame, shingle_words: int) -> DataFrame:
    """(class, first): of each class of ``signed`` the first row (no_id, doc_id, row_key) of its component.

    Rows with an id come before those without. ``id`` is the number of a class here, as for all
    that this calls; the text of its first row is read for its full set.
    """
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    classes = signed.where("class is not null").groupBy("class").agg(F.min(row).alias("first"))
    classes = materialize(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    first = (
        signed.join(classes.select("id", "class", "first.row_key"), ["class", "row_key"])
        .select("id", "row_key", "n_shingles", "sketch", "keys").dropDuplicates(["id"])
    )
    first = materialize(first, "representatives")
    banded = first.select("id", F.posexplode("keys").alias("band", "bucket"))
    filled = banded.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1")
    members = materialize(banded.join(filled, "bucket"), "buckets")

    colliding = first.select("id", "row_key").join(members.select("id").distinct(), "id")
    first = first.drop("row_key")
    sets = materialize(_sets(rows.join(colliding, "row_key").select("id", "text"), shingle_words), "sets")
    sets = sets.dropDuplicates(["id"])

    cells = members.withColumn("cell", _cell(F.ceil(F.col("m") / CELL), "id", "bucket"))
    cells = cells.join(first.drop("keys"), "id").select(
        "bucket", "cell", "id", F.col("id").alias("component"), "n_shingles", "sketch"
    )
    ordered = cells.repartition("bucket", "cell").sortWithinPartitions("bucket", "cell")
    proposed = ordered.mapInArrow(_forest, "a long, b long")
    tested = _confirmed(proposed, sets)
    links = tested.where("linked").select("a", "b")
    joined = connected_components(links)

    few, many = _unresolved(members, first, sets, joined)
    again = few.mapInArrow(_across, "a long, b long").distinct().join(tested, ["a", "b"], "left_anti")
    more = _confirmed(again, sets).where("linked").select("a", "b")
    more = materialize(more.union(many.mapInArrow(_linked_across, "a long, b long")).distinct(), "more_links")
    if more.limit(1).count():
        joined = connected_components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    joined = joined.withColumnRenamed("node", "id")
    least = joined.join(classes.select("id", "first"), "id").groupBy("component").agg(F.min("first").alias("least"))
    placed = classes.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
    return placed.join(least, "component", "left").select("class", F.coalesce("least", "first").alias("first"))


def _unresolved(
    members: DataFrame, first: DataFrame, sets: DataFrame, joined: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Rows of the second round, in cell order: of buckets of few meetings, and of many with sets.

    A bucket of several components: the texts outside its largest one are the left side, dealt to
    t; all its texts are the right side, dealt to u. Every left text meets every right one once. A
    bucket of two texts was settled in the first round.
    """
    known = members.join(joined.withColumnRenamed("node", "id"), "id", "left").select(
        "bucket", "band", "id", F.coalesce("component", "id").alias("component")
    )
    known = materialize(known, "known")
    sizes = known.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    open_ = (
        sizes.groupBy("bucket")
        .agg(F.sum("n").alias("m"), F.max("n").alias("most"), F.max_by("component", F.struct("n", "component")).alias("largest"), F.count("*").alias("parts"))
        .where("parts > 1 and m > 2")
        .select("bucket", "largest", ((F.col("m") - F.col("most")) * F.col("m") > FEW_PAIRS).alias("many"), F.ceil((F.col("m") - F.col("most")) / LEFT_CELL).alias("ts"), F.ceil(F.col("m") / RIGHT_CELL).alias("us"))
    )
    rows = known.join(open_, "bucket")
    deal = lambda n: F.explode(F.sequence(F.lit(0), (F.col(n) - 1).cast("int")))
    left = rows.where("component <> largest").select(
        "*", _cell(F.col("ts"), "id", F.lit(1)).alias("t"), deal("us").alias("u"), F.lit(0).alias("side")
    )
    right = rows.select("*", deal("ts").alias("t"), _cell(F.col("us"), "id", F.lit(2)).alias("u"), F.lit(1).alias("side"))
    both = left.unionByName(right).select("bucket", "t", "u", "side", "band", "id", "component", "many")
    both = materialize(both, "open")

    def ordered(rows: DataFrame) -> DataFrame:
        return rows.repartition("bucket", "t", "u").sortWithinPartitions("bucket", "t", "u", "side")

    few = both.where("not many").drop("many").join(first, "id")
    many = both.where("many").drop("many").join(first, "id").join(sets, "id")
    return ordered(few), ordered(many)
