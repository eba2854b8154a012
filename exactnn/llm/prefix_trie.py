"""Prefix trie of conversations: double arrays by prefix shard, upper nodes merged globally.

* Turns get their place by a range sort, and a pair of 64-bit hashes; a prefix is named by the XOR
  of hashes of its turns at their places. Conversations of one sequence are one weighted row.
* A prefix that too many turns share is split by its next turn, and again, down to SPLIT_DEPTH
  turns, then by hash. What shares the remaining prefix is a shard. Nodes from the depth of the
  split on lie in one shard only; the upper ones may be in several.
* A task packs shards into one double array: a node's BASE plus the dense number of a turn is the
  cell of its child, whose CHECK names the node. Walking the sequences over it gives the nodes'
  members, and from the deepest level up their children, leaves and sums.
* Upper nodes leave their shard as partial sums, are merged by name, and are added up along their
  own parents in as many steps as the logarithm of their depth.

A sequence of more than PIECE_TURNS turns is cut into pieces, each but the first a shard of its own
below the node where it begins; all its nodes are upper ones.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from exactnn.operators.ids import dense_index
from exactnn.operators.joins import split_join
from exactnn.session import materialize, parallelism

#: Turns of a piece of a sequence, and of a prefix above which it is split by its next turn.
PIECE_TURNS, SHARD_TURNS = 1024, 1 << 18
#: Turns down to which prefixes are split; below, a hot one is dealt by hash.
SPLIT_DEPTH = 8
#: Turns that a double array is packed for.
ARRAY_TURNS = 1 << 19
#: Conversation ids of one chunk of a member list.
CHUNK_BITS = 12
#: Rows of upper nodes up to which they are broadcast (some 40 bytes each).
FEW_NODES = 200_000
#: Places looked at for a node of several children before it goes to the end.
_TRIES = 256
_NO_CONV = np.iinfo(np.int64).max
_EVER = 1 << 60
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# --- sequences -----------------------------------------------------------------------------------


def ordered_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, pos, t1, t2, n_chars) of all turns, by turn number.

    No task holds a whole conversation: positions are those of a range sort less the first one.
    """
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    keyed = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), role_.alias("role"),
        F.xxhash64(role_, text_).alias("t1"), F.xxhash64(F.lit(7), text_, role_).alias("t2"),
        F.length(text_).cast("long").alias("n_chars"),
    )
    placed = dense_index(keyed, ["conv_id", "turn", "role", "t1", "t2"], "idx")
    first = placed.groupBy("conv_id").agg(F.min("idx").alias("first"))
    placed = placed.join(first, "conv_id").select("conv_id", (F.col("idx") - F.col("first")).alias("pos"), "t1", "t2", "n_chars")
    return materialize(placed, "turns")


def rebuilt(turns: DataFrame, family: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, at, t1, t2, n_chars, ga, gb), and all conv_ids.

    Conversation c: the first h turns of c - c % ``family``, then its own after its first h, with
    h = crc32(c) % ``most``.
    """
    conv = F.col("conv_id")
    counts = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    base = counts.where(conv % family == 0).select(conv.alias("base"), F.col("n").alias("base_n"))
    heads = F.crc32(conv.cast("string").cast("binary")) % most
    convs = counts.select("conv_id", heads.alias("h"), (conv - conv % family).alias("base")).join(base, "base", "left")
    convs = materialize(convs.withColumn("kept", F.least("h", F.coalesce("base_n", F.lit(0)))), "convs")
    opening = turns.where((conv % family == 0) & (F.col("pos") < most - 1)).withColumnRenamed("conv_id", "base")
    opening = convs.join(opening, "base").where("pos < h").select("conv_id", F.col("pos").alias("at"), "t1", "t2", "n_chars")
    own = turns.join(convs, "conv_id").where("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("kept")).alias("at"), "t1", "t2", "n_chars"
    )
    rows = opening.unionByName(own).withColumns(
        {"ga": F.xxhash64("t1", "t2", "at"), "gb": F.xxhash64("at", "t2", "t1", F.lit(1))}
    )
    return materialize(rows, "rebuilt"), convs.select("conv_id")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each sequence, its members' ids hashed as they stream by in order."""
    current, held = None, None
    names = ["len", "a", "b", "n", "rep", "ends"]
    out: list[tuple] = []

    def close() -> None:
        if current is not None:
            out.append((*current, held[0], held[1], held[2].hexdigest()))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        kinds = [pa.int64()] * 5 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        for length, a, b, n, rep, text in zip(*[batch.column(c).to_pylist() for c in ("len", "a", "b", "n", "rep", "ids")], strict=True):
            if (length, a, b) != current:
                close()
                current, held = (length, a, b), [0, rep, hashlib.sha256()]
            else:
                held[2].update(b",")
            held[0] += n
            held[1] = min(held[1], rep)
            held[2].update(text.encode())
        if len(out) > 10_000:
            yield batch_of(out)
            out = []
    close()
    yield batch_of(out)


def distinct_sequences(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """(len, a, b, n, rep, ends): each distinct sequence with its members.

    Ids are joined in chunks that hold a bounded number of them, so a group of copies is hashed as
    a stream of chunks, never held.
    """
    marks = convs.select("conv_id", F.lit(0).cast("long").alias("ga"), F.lit(0).cast("long").alias("gb"))
    names = rows.select("conv_id", "ga", "gb").unionByName(marks).groupBy("conv_id").agg(
        (F.count("*") - 1).alias("len"), F.bit_xor("ga").alias("a"), F.bit_xor("gb").alias("b")
    )
    chunks = names.groupBy("len", "a", "b", F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(
        F.count("*").alias("n"), F.min("conv_id").alias("rep"),
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"),
    )
    ordered = chunks.repartition("len", "a", "b").sortWithinPartitions("len", "a", "b", "chunk")
    found = ordered.mapInArrow(_ends, "len long, a long, b long, n long, rep long, ends string")
    return materialize(found, "sequences")


def _pieces(rows: DataFrame, groups: DataFrame, piece_turns: int) -> DataFrame:
    """(rep, piece, n, len, ends, sa, sb, turns): pieces of distinct sequences, one at least each."""
    turn = F.struct("at", "t1", "t2", "ga", "gb", "n_chars")
    known = groups.select(F.col("rep").alias("conv_id"), "n", "len", "ends")
    pieces = (
        rows.join(known, "conv_id")
        .groupBy(F.col("conv_id").alias("rep"), F.expr(f"at div {piece_turns}").alias("piece"), "n", "len", "ends")
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"), F.bit_xor("ga").alias("xa"), F.bit_xor("gb").alias("xb"))
    )
    none = groups.where("len = 0").select(
        "rep", F.lit(0).cast("long").alias("piece"), "n", "len", "ends",
        F.array().cast("array<struct<at:bigint,t1:bigint,t2:bigint,ga:bigint,gb:bigint,n_chars:bigint>>").alias("turns"),
        F.lit(0).cast("long").alias("xa"), F.lit(0).cast("long").alias("xb"),
    )
    pieces = pieces.unionByName(none)
    zero = F.lit(0).cast("long")
    if groups.where(F.col("len") > piece_turns).limit(1).count():
        before = Window.partitionBy("rep").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
        pieces = pieces.withColumns(
            {s: F.coalesce(F.bit_xor(x).over(before), zero) for s, x in (("sa", "xa"), ("sb", "xb"))}
        )
    else:
        pieces = pieces.withColumns({"sa": zero, "sb": zero})
    return materialize(pieces.drop("xa", "xb"), "pieces")


def _prefix(depth: Column | int, name: str) -> Column:
    """XOR of the first ``depth`` turns' hashes."""
    return F.aggregate(F.slice("turns", 1, depth), F.lit(0).cast("long"), lambda x, t: x.bitwiseXOR(t[name]))


def _sharded(pieces: DataFrame, piece_turns: int, shard_turns: int) -> DataFrame:
    """``pieces`` with the shard (g1, g2) and the depth from which on nodes are in no other one."""
    size = F.size("turns")
    first = F.col("piece") == 0  # also of a long sequence: its opening lies in the shard of its prefix
    prefixes = pieces.where(first & (size > 0)).select(
        "rep", F.explode(F.sequence(F.lit(1), F.least(size, F.lit(SPLIT_DEPTH)))).alias("d"), "turns", size.alias("w")
    ).select("rep", "d", _prefix(F.col("d"), "ga").alias("pa"), _prefix(F.col("d"), "gb").alias("pb"), "w")
    hot = prefixes.groupBy("d", "pa", "pb").agg(F.sum("w").alias("total")).where(F.col("total") > shard_turns)
    hot = materialize(hot, "hot_prefixes")  # at most SPLIT_DEPTH * turns / shard_turns rows
    if hot.limit(1).count():
        depths = prefixes.join(F.broadcast(hot), ["d", "pa", "pb"]).groupBy("rep").agg(
            F.count("*").cast("int").alias("hot"), F.min("total").alias("total")
        )
        pieces = pieces.join(depths, "rep", "left")
    else:
        pieces = pieces.withColumns({"hot": F.lit(None).cast("int"), "total": F.lit(None).cast("long")})
    split = F.coalesce("hot", F.lit(0)) + 1
    deep = split > SPLIT_DEPTH
    at = F.least(split, F.lit(SPLIT_DEPTH))
    salt = F.when(deep, F.pmod(F.xxhash64("rep"), F.ceil(F.col("total") / shard_turns))).otherwise(F.lit(0))
    g1 = F.when(first, F.xxhash64(_prefix(at, "ga"), salt)).otherwise(F.xxhash64("rep", "piece"))
    g2 = F.when(first, _prefix(at, "gb")).otherwise(F.col("rep"))
    alone = F.when(first & (F.col("len") <= piece_turns) & ~deep, split.cast("long")).otherwise(F.lit(_EVER))
    return pieces.select("rep", "piece", "n", "len", "ends", "sa", "sb", "turns", g1.alias("g1"), g2.alias("g2"), alone.alias("alone"))


# --- double arrays ---------------------------------------------------------------------------------


class DoubleArray:
    """BASE and CHECK over dense turn numbers. Roots take the first cells."""

    def __init__(self, roots: int):
        size = 1 << max(6, int(roots).bit_length() + 1)
        self.base = np.zeros(size, np.int64)
        self.check = np.full(size, -1, np.int64)
        self.used = np.zeros(size, bool)
        self.used[:roots] = True
        self._low, self._end = roots, roots

    def _grow(self, size: int) -> None:
        if size > len(self.used):
            more = max(size, 2 * len(self.used)) - len(self.used)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])
            self.used = np.concatenate([self.used, np.zeros(more, bool)])

    def _free(self, k: int) -> np.ndarray:
        """The first ``k`` free cells."""
        while self._low < len(self.used) and self.used[self._low]:
            full = np.flatnonzero(~self.used[self._low : self._low + 4096])
            self._low += int(full[0]) if len(full) else 4096
        span = 2 * k + 64
        while True:
            self._grow(self._low + span)
            found = np.flatnonzero(~self.used[self._low : self._low + span])
            if len(found) >= k:
                return self._low + found[:k]
            span *= 2

    def _take(self, cells: np.ndarray, parents: np.ndarray) -> None:
        self.used[cells] = True
        self.check[cells] = parents
        self._end = max(self._end, int(cells.max()) + 1)

    def add(self, parents: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Cells of new children, by parent and code; parents have no children yet."""
        heads = np.flatnonzero(np.append(True, parents[1:] != parents[:-1]))
        sizes = np.diff(np.append(heads, len(parents)))
        cells = np.empty(len(parents), np.int64)
        for first, size in zip(heads[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
            steps = codes[first : first + size] - codes[first]
            tries = self._free(_TRIES)
            self._grow(int(tries[-1] + steps[-1]) + 1)
            at = None
            for some in (tries[:16], tries[16:]):
                fits = np.flatnonzero(~self.used[some[:, None] + steps].any(axis=1))
                if len(fits):
                    at = int(some[fits[0]])
                    break
            if at is None:
                at = self._end
                self._grow(at + int(steps[-1]) + 1)
            cells[first : first + size] = at + steps
            self._take(cells[first : first + size], parents[first : first + size])
            self.base[parents[first]] = at - codes[first]
        one = heads[sizes == 1]
        if len(one):
            cells[one] = self._free(len(one))
            self._take(cells[one], parents[one])
            self.base[parents[one]] = cells[one] - codes[one]
        return cells

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The children of ``states`` by ``codes``; -1 where there is none."""
        cells = self.base[states] + codes
        inside = (cells >= 0) & (cells < len(self.check))
        found = np.where(inside, cells, 0)
        return np.where(inside & (self.check[found] == states), found, -1)


class _Shards:
    """Pieces of some shards, flat."""

    def __init__(self, batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches).combine_chunks()
        column = lambda name: table.column(name).to_numpy()
        self.rep, self.n, self.alone = column("rep"), column("n"), column("alone")
        self.piece = column("piece")
        turns = table.column("turns").combine_chunks()
        flat = turns.flatten()
        self.sizes = np.diff(turns.offsets.to_numpy()).astype(np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        field = lambda name: flat.field(name).to_numpy()
        self.ga, self.gb, self.chars = field("ga"), field("gb"), field("n_chars")
        self.depth0 = np.where(self.sizes > 0, field("at")[np.minimum(self.first, max(0, len(flat) - 1))], 0) if len(flat) else self.sizes * 0
        self.last = self.depth0 + self.sizes == column("len")
        self.ends = table.column("ends").to_pylist()
        one, names_1 = pd.factorize(field("t1"))
        two, names_2 = pd.factorize(field("t2"))
        level = np.arange(len(one)) - np.repeat(self.first, self.sizes)
        order = np.argsort(level, kind="stable")  # numbers by level, so that children lie close
        codes, names = pd.factorize((one * (len(names_2) + 1) + two)[order])
        self.codes = np.empty(len(one), np.int64)
        self.codes[order] = codes
        self.alphabet = len(names) + 1
        starts = pd.MultiIndex.from_arrays([self.piece, column("sa"), column("sb")])
        self.root, roots = pd.factorize(starts)
        self.roots = [np.array(x) for x in zip(*roots, strict=True)] if len(roots) else [np.zeros(0, np.int64)] * 3

    def levels(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, places of their turns) of one level after another."""
        alive = np.flatnonzero(self.sizes > 0)
        level = 0
        while len(alive):
            yield alive, self.first[alive] + level
            level += 1
            alive = alive[self.sizes[alive] > level]


def _nodes(shards: _Shards) -> pa.RecordBatch:
    """The nodes of the shards' trie; upper ones as partial sums."""
    roots = len(shards.roots[0])
    trie = DoubleArray(roots)
    state = shards.root.astype(np.int64)
    for rows, at in shards.levels():
        pair, back = np.unique(state[rows] * shards.alphabet + shards.codes[at], return_inverse=True)
        cells = trie.add(pair // shards.alphabet, pair % shards.alphabet)
        state[rows] = cells[back]

    size = len(trie.check)
    n, least, chars = np.zeros(size, np.int64), np.full(size, _NO_CONV), np.zeros(size, np.int64)
    depth, a, b = (np.zeros(size, np.int64) for _ in range(3))
    upper, end = np.zeros(size, bool), np.full(size, -1, np.int64)
    piece, sa, sb = shards.roots
    depth[:roots], a[:roots], b[:roots], upper[:roots] = 0, sa, sb, True
    state = shards.root.astype(np.int64)
    depth[state] = shards.depth0
    opening = shards.piece == 0  # the members of a later piece's first node are counted by the piece before
    np.add.at(n, state[opening], shards.n[opening])
    np.minimum.at(least, state[opening], shards.rep[opening])
    end[state[shards.sizes == 0]] = np.flatnonzero(shards.sizes == 0)
    levels = []
    for rows, at in shards.levels():
        before = state[rows]
        now = trie.step(before, shards.codes[at])
        state[rows] = now
        np.add.at(n, now, shards.n[rows])
        np.minimum.at(least, now, shards.rep[rows])
        chars[now], depth[now] = shards.chars[at], depth[before] + 1
        a[now], b[now] = a[before] ^ shards.ga[at], b[before] ^ shards.gb[at]
        upper[now[shards.alone[rows] > depth[now]]] = True
        closing = shards.last[rows] & (at + 1 == shards.first[rows] + shards.sizes[rows])
        end[now[closing]] = rows[closing]
        levels.append(np.unique(now))

    parent = trie.check
    kids, leaves, saved = (np.zeros(size, np.int64) for _ in range(3))
    for nodes in levels:
        np.add.at(kids, parent[nodes[~upper[nodes]]], 1)
    for nodes in reversed(levels):
        own = nodes[~upper[nodes]]
        leaves[own] += kids[own] == 0
        saved[own] += (n[own] - 1) * chars[own]
        np.add.at(leaves, parent[own], leaves[own])
        np.add.at(saved, parent[own], saved[own])

    nodes = np.concatenate([np.arange(roots), *levels])
    above = np.maximum(parent[nodes], 0)
    root = parent[nodes] < 0
    inner = ~root & ~upper[above]  # exclusive nodes below exclusive ones know their parent
    named = root | inner
    conv = least[nodes]
    ends = [shards.ends[i] if i >= 0 else None for i in end[nodes].tolist()]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(upper[nodes]), pa.array(depth[nodes]), pa.array(a[nodes]), pa.array(b[nodes]),
            pa.array(a[above], mask=named), pa.array(b[above], mask=named), pa.array(conv, mask=conv == _NO_CONV),
            pa.array(least[above], mask=~inner), pa.array(n[nodes]), pa.array(chars[nodes]), pa.array(kids[nodes]),
            pa.array(leaves[nodes]), pa.array(saved[nodes]), pa.array(ends, pa.string()),
        ],
        ["upper", "depth", "a", "b", "pa", "pb", "conv_id", "parent_conv_id", "n_convs", "chars", "n_children", "n_leaves", "saved_tokens", "ends"],
    )


_NODES = (
    "upper boolean, depth long, a long, b long, pa long, pb long, conv_id long, parent_conv_id long, n_convs long, "
    "chars long, n_children long, n_leaves long, saved_tokens long, ends string"
)


def _tries(array_turns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, turns, current = [], 0, None
        for batch in batches:
            key = [batch.column(c).to_numpy() for c in ("g1", "g2")]
            edge = np.flatnonzero((key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])) + 1
            edges = [0, *edge.tolist(), batch.num_rows]
            sizes = np.concatenate([[0], np.cumsum(np.diff(batch.column("turns").offsets.to_numpy()))])
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                own = (int(key[0][a]), int(key[1][a]))
                if own != current and turns >= array_turns:
                    yield _nodes(_Shards(held))
                    held, turns = [], 0
                current = own
                held.append(batch.slice(a, b - a))
                turns += int(sizes[b] - sizes[a])
        if held:
            yield _nodes(_Shards(held))

    return run


# --- the job ---------------------------------------------------------------------------------------


def _merged_upper(parts: DataFrame) -> DataFrame:
    """Upper nodes with whole sums, their parents' smallest member and names."""
    merged = parts.where("upper").groupBy("depth", "a", "b").agg(
        F.max("pa").alias("pa"), F.max("pb").alias("pb"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.max("chars").alias("chars"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.max("ends").alias("ends"),
    )
    merged = materialize(merged.withColumn("id", F.monotonically_increasing_id()), "upper")
    above = merged.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"),
        F.col("id").alias("up"), F.col("conv_id").alias("parent_conv_id"),
    )
    nodes = materialize(merged.join(above, ["depth", "pa", "pb"], "left"), "upper_nodes")
    inside = nodes.groupBy(F.col("up").alias("id")).agg(F.count("*").alias("more")).where("id is not null")
    nodes = nodes.join(inside, "id", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    own = F.when(F.col("n_children") == 0, 1).otherwise(0)
    sums = materialize(nodes.select(
        "id", "up", (F.col("n_leaves") + own).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    ), "upper_sums")
    # after r steps a node has the sums of all within 2 ** r levels, and ``up`` is that far above
    while sums.where("up is not null").limit(1).count():
        below = sums.where("up is not null").groupBy(F.col("up").alias("id")).agg(
            F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s")
        )
        far = sums.select(F.col("id").alias("up"), F.col("up").alias("far"))
        sums = materialize(sums.join(below, "id", "left").join(far, "up", "left").select(
            "id", F.col("far").alias("up"), (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("s", F.lit(0))).alias("saved_tokens"),
        ), "upper_sums")
    return materialize(nodes.drop("n_leaves", "saved_tokens", "up", "more").join(sums.drop("up"), "id"), "upper_whole")


def prefix_trie(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    piece_turns: int = PIECE_TURNS, shard_turns: int = SHARD_TURNS, array_turns: int = ARRAY_TURNS,
) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 by node.

    Conversations are rebuilt first (see :func:`rebuilt`). A node is a distinct sequence of first
    turns (role and text); ``conv_id`` is its smallest member, ``saved_tokens`` sums (members - 1)
    * code points of the last text over its subtree, ``ends_sha256`` hashes the members that end there.

    Turns go by number, null first; those of one number by role, then by a hash of the text, so
    repeated rows are turns of their own. Null roles and texts are empty; rows without a conv_id
    take no part; other columns are not looked at; of no conversations nothing is returned.
    """
    spark = turns.sparkSession
    ordered = ordered_turns(turns, conv, turn, role, text)
    rows, convs = rebuilt(ordered)
    groups = distinct_sequences(rows, convs)
    pieces = _pieces(rows, groups, piece_turns)
    total = pieces.agg(F.coalesce(F.sum(F.size("turns")), F.lit(0)).alias("n")).first().n
    tasks = max(parallelism(spark), math.ceil(total / shard_turns))
    shards = _sharded(pieces, piece_turns, shard_turns).repartition(tasks, "g1", "g2").sortWithinPartitions("g1", "g2")
    parts = materialize(shards.mapInArrow(_tries(array_turns), _NODES), "nodes")
    upper = _merged_upper(parts)
    known = upper.select(F.struct((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb")).alias("place"), F.col("conv_id").alias("above"))
    below = parts.where("not upper and pa is not null").withColumn("place", F.struct("depth", "pa", "pb"))
    if upper.limit(FEW_NODES + 1).count() <= FEW_NODES:
        below = below.join(F.broadcast(known), "place", "left")
    else:
        below = split_join(below, known, "place", "conv_id", "left")
    below = below.drop("parent_conv_id").withColumnRenamed("above", "parent_conv_id")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    found = parts.where("not upper and pa is null").select(*names).unionByName(below.select(*names)).unionByName(upper.select(*names))
    return found.withColumn("ends", F.coalesce("ends", F.lit(_EMPTY_SHA))).withColumnRenamed("ends", "ends_sha256")
