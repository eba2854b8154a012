"""The conversation trie against plain loops."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from exactnn.llm import prefix_trie as T

NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _plain(rows):
    """Rows (conv_id, turn, role, text) without ties of a turn's number."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: t[:3])] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])
        built[c] = tuple(base[:h] + turns[h:])
    members, ends = {}, {}
    for c, turns in built.items():
        ends.setdefault(turns, []).append(c)
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = []
    for path, own in members.items():
        below = [p for p in members if p[: len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        leaf = lambda p: not any(q[:-1] == p for q in members if len(q) == len(p) + 1)
        out.append((
            min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(kids), sum(map(leaf, below)),
            sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
            hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def _made(seed, convs, words, longest):
    rng = random.Random(seed)
    ids = rng.sample(range(-150, 450), convs)
    rows = []
    for c in ids:
        n = rng.randint(1, longest)
        style = rng.random()
        for t in range(n):
            text = "hot" if t == 0 and style < 0.6 else rng.choice(words)
            rows.append((c, None if t == 0 else t, rng.choice(["user", None]) if style > 0.9 else "user", text))
    rng.shuffle(rows)
    return [*rows, (None, 1, "user", "nobody")]


def _got(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=repr)


@pytest.mark.parametrize("piece, shard, array, depth", [(1024, 1 << 18, 1 << 19, 8), (4, 1 << 18, 10, 8), (1024, 12, 20, 8), (1024, 9, 1, 2), (3, 6, 30, 2)])
def test_against_loops(spark, monkeypatch, piece, shard, array, depth):
    monkeypatch.setattr(T, "SPLIT_DEPTH", depth)
    monkeypatch.setattr(T, "CHUNK_BITS", 3)
    rows = _made(depth + piece, 70, ["a", "b", "long text", "é漢😀", "", None], 9)
    turns = spark.createDataFrame([(*r, 1, 2, "z") for r in rows], "conv_id long, turn int, role string, text string, n int, rep int, ends string")
    assert _got(T.prefix_trie(turns.repartition(3), piece_turns=piece, shard_turns=shard, array_turns=array)) == _plain(rows)


def test_many_upper_nodes_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(T, "FEW_NODES", 1)
    rows = _made(5, 60, ["a", "b"], 6)
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    assert _got(T.prefix_trie(turns, shard_turns=8)) == _plain(rows)


def test_ties_and_repeated_rows(spark):
    """Turns of one number go by role; a repeated row is one more turn."""
    rows = [(500, 1, "b", "x"), (500, 1, "a", "y"), (500, 2, "a", "z"), (500, 2, "a", "z")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = T.prefix_trie(turns).collect()
    assert sorted(r.depth for r in found) == [0, 1, 2, 3, 4] and all(r.n_convs == 1 for r in found)
    placed = T.ordered_turns(turns, "conv_id", "turn", "role", "text").orderBy("pos").collect()
    plain = turns.selectExpr("xxhash64(role, text) h", "role", "text").collect()
    name = {r.h: (r.role, r.text) for r in plain}
    assert [name[r.t1] for r in placed] == [("a", "y"), ("b", "x"), ("a", "z"), ("a", "z")]


def test_no_conversations(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert T.prefix_trie(turns).count() == 0


def test_one_long_conversation(spark):
    rows = [(700, t, "user", str(t)) for t in range(600)] + [(799, t, "user", str(t)) for t in range(3)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.depth: r for r in T.prefix_trie(turns, piece_turns=90).where("conv_id = 700").collect()}
    assert len(found) == 601 and found[599].n_children == 1 and found[600].n_children == 0
    assert found[1].parent_conv_id == 700 and all(r.n_leaves >= 1 for r in found.values())


def test_double_array_cells():
    """Any set of children is found again, and nothing else."""
    rng = np.random.default_rng(2)
    for _ in range(20):
        alphabet, trie = 50, T.DoubleArray(3)
        nodes, edges = [0, 1, 2], {}
        for _ in range(5):
            rows = sorted({(int(rng.choice(nodes)), int(rng.integers(alphabet))) for _ in range(40)})
            rows = [r for r in rows if not any(e[0] == r[0] for e in edges)]
            if not rows:
                continue
            cells = trie.add(*(np.array(x) for x in zip(*rows, strict=True)))
            edges.update(zip(rows, cells.tolist(), strict=True))
            nodes = nodes + cells.tolist()
        assert len(set(edges.values())) == len(edges)
        for node in nodes:
            codes = np.arange(alphabet)
            found = trie.step(np.full(alphabet, node), codes).tolist()
            assert found == [edges.get((node, c), -1) for c in codes.tolist()]
