"""Near-duplicates and repeated strings against plain Python."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from exactnn.llm import bwt_dedup as W
from exactnn.llm import odd_minhash as M
from exactnn.llm.components import connected_components
from exactnn.llm.queries import op7_repeated_strings

# --- near-duplicates -------------------------------------------------------------------------------


def _shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if len(words) < 4:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 4]) for i in range(len(words) - 3))


def _plain_near(rows):
    """rows: (doc_id, text) with unique ids or null ones."""
    sets = [(i, _shingles(t)) for i, t in rows]
    known = [(i, s) for i, s in sets if i is not None and s]
    parent = {i: i for i, _ in known}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, s) in enumerate(known):
        for j, t in known[:n]:
            common = len(s & t)
            if 100 * common >= 80 * (len(s) + len(t) - common):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return sorted(
        ((i, len(s), root(i) if i in parent else i, i is None or i not in parent or root(i) == i) for i, s in sets), key=repr
    )


def _copies(rng, base, n, most):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, most)):
            at = rng.randrange(len(words))
            words[at : at + rng.randint(0, 2)] = ["".join(rng.choice("abcdef") for _ in range(5))]
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize(
    "cell, left, right, few", [(512, 512, 1 << 16, 1 << 20), (4, 3, 5, 1 << 20), (4, 3, 5, 0), (4, 512, 1 << 16, 9)]
)
def test_near_duplicates(spark, odd_docs, monkeypatch, cell, left, right, few):
    for name, value in (("CELL", cell), ("LEFT_CELL", left), ("RIGHT_CELL", right), ("FEW_PAIRS", few)):
        monkeypatch.setattr(M, name, value)
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = []
    for n, most in ((60, 6), (40, 3), (5, 8), (2, 1)):
        texts += _copies(rng, [word() for _ in range(120)], n, most)
    texts += ["One two three", "one TWO  three", "one two", "É x", "é x", "a b c d", "a\tb\nc\x0bd", "a b c d a b c d", "\x1c", "A"]
    odd = odd_docs.select("doc_id", "text").dropDuplicates(["doc_id"]).where("doc_id is not null and doc_id > 20").limit(60)
    docs = spark.createDataFrame([*list(enumerate(texts, 1000)), (None, texts[0]), (None, None)], "doc_id long, text string").unionByName(odd)
    rows = [tuple(r) for r in docs.collect()]
    got = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=4).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=repr) == _plain_near(rows)


def test_repeated_ids_and_other_columns(odd_docs, no_docs):
    rows = M.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert M.near_duplicates(no_docs).count() == 0


def _plain_reused(rows):
    """As _plain_near, but rows are the nodes and ids may repeat; none is null."""
    sets = [_shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for n, s in enumerate(sets):
        for j, t in enumerate(sets[:n]):
            common = len(s & t)
            if s and t and 100 * common >= 80 * (len(s) + len(t) - common):
                group = [group[j] if g == group[n] else g for g in group]
    least = {g: min(rows[k][0] for k in range(len(rows)) if group[k] == g) for g in group}
    return sorted((i, len(s), least[g], i == least[g]) for (i, _), s, g in zip(rows, sets, group, strict=True))


def test_texts_that_share_an_id(spark):
    rng = random.Random(5)
    base = [[f"w{rng.randrange(10**6)}" for _ in range(80)] for _ in range(4)]
    a, b, *_ = (" ".join(w) for w in base)
    rows = [(5, a), (5, b), (3, " ".join([*base[0], "more"]))]
    rows += [(rng.randrange(10, 25), t) for w in base[1:] for t in _copies(rng, w, 14, 3)] + [(12, ""), (12, " ")]
    for some in (rows[:3], rows):
        got = M.near_duplicates(spark.createDataFrame(some, "doc_id long, text string"), shingle_words=4).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == _plain_reused(some)


def test_sketches_screen_without_losing_links():
    rng = np.random.default_rng(4)
    limit, lost, passed = M.most_bits(), 0, 0
    for n in (5, 40, 400, 3000):
        for _ in range(60):
            own = rng.integers(0, 2**63, n, dtype=np.uint64)
            part = n - int(0.111 * n)  # similarity just above 0.8
            other = np.concatenate([own[:part], rng.integers(0, 2**63, n - part, dtype=np.uint64)])
            far = np.concatenate([own[: n // 4], rng.integers(0, 2**63, n - n // 4, dtype=np.uint64)])
            x, y, z = (np.frombuffer(M.odd_sketch(M.min_hashes(np.unique(s))), np.uint64) for s in (own, other, far))
            lost += int(np.bitwise_count(x ^ y).sum()) > limit
            passed += int(np.bitwise_count(x ^ z).sum()) <= limit
    assert lost == 0 and passed < 10


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + [(500, 500), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert got == {x: root(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- repeated strings ------------------------------------------------------------------------------


def _plain_removed(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(r, gone, strict=False) if not g)
        left = kept.decode(errors="ignore")
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), left))
    return out


def _repeating(rng):
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 6)))
    passage = [" ".join(word() for _ in range(n)) for n in (4, 9, 15, 40)]
    texts = []
    for _ in range(120):
        parts = [" ".join(word() for _ in range(rng.randint(0, 12)))]
        for _ in range(rng.randint(0, 3)):
            parts.insert(rng.randint(0, len(parts)), rng.choice(passage)[rng.randint(0, 3) :])
        texts.append("".join(parts))
    return [*texts, texts[5], texts[5], "z" * 500, "zy" * 300, "", None, texts[7][:40]]


@pytest.mark.parametrize("hot, block", [(1 << 22, 1 << 20), (300, 500), (1 << 22, 2000)])
def test_removed_bytes(spark, hot, block):
    texts = _repeating(random.Random(block))
    rows = [(i if i != 3 else None, t, 1, 2) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int, id int").repartition(3)
    options = {"length": 30, "gram": 9, "block_bytes": block, "hot_bytes": hot}
    got = sorted((tuple(r) for r in W.removal_report(docs, **options).collect()), key=repr)
    assert got == sorted(((r[0], *p) for r, p in zip(rows, _plain_removed(texts, 30), strict=True)), key=repr)
    cut = {r.doc_id: r for r in W.remove_repeats(docs, **options).collect()}
    assert len(cut) == len(rows) and cut[0].start == 1 and cut[len(texts) - 2].text is None
    for (i, *_), (_, removed, *_) in zip(rows, _plain_removed(texts, 30), strict=True):
        if not removed:
            assert cut[i].text == texts[i if i is not None else 3]


def test_query_on_documents(spark, sf, documents):
    texts = documents.select("doc_id", "text").orderBy("doc_id").collect()
    got = sorted(tuple(r) for r in op7_repeated_strings(spark, sf).collect())
    assert got == [(r.doc_id, *p) for r, p in zip(texts, _plain_removed([t.text for t in texts], 400), strict=True)]


def test_long_texts_are_cut_in_overlapping_pieces(monkeypatch):
    data = np.frombuffer(random.Random(1).randbytes(5000), np.uint8)
    whole = W.segments(data, np.array([0, 5000]), 40, 10)
    monkeypatch.setattr(W, "PIECE_BYTES", 900)
    windows = set()
    for _, _, begin, end in W._pieces(np.array([0, 5000]), 40):
        v, _, start, size, _ = W.segments(data[begin:end], np.array([0, end - begin]), 40, 10)
        windows |= {(int(m), begin + s + i) for m, s, n in zip(v, start.tolist(), size.tolist(), strict=True) for i in range(n - 39)}
    v, _, start, size, _ = whole
    assert windows == {(int(m), s + i) for m, s, n in zip(v, start.tolist(), size.tolist(), strict=True) for i in range(n - 39)}
    assert {p for _, p in windows} == set(range(5000 - 39))


def test_suffix_array_and_intervals():
    rng = random.Random(1)
    for _ in range(150):
        length = rng.choice([1, 2, 3, 5, 20])
        parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(1, 8))]
        parts += parts[:2] * rng.randint(0, 1)
        text = np.frombuffer(b"".join(bytes(x + 1 for x in p) + b"\0" for p in parts), np.uint8)
        begins = np.cumsum([0, *[len(p) + 1 for p in parts]])[:-1]
        found, name = W.repeated_places(text, begins, length)
        seen = Counter(p[i : i + length] for p in parts for i in range(len(p) - length + 1))
        names = {}
        for p, b in zip(parts, begins.tolist(), strict=True):
            for i in range(len(p) + 1):
                own = p[i : i + length]
                assert found[b + i] == (len(own) == length and seen[own] > 1)
                if len(own) == length:
                    assert names.setdefault(own, name[b + i]) == name[b + i]


def test_one_of_each_keeps_columns_of_any_name(spark):
    text = "some words that stand here twice or more in all"
    rows = [(1, text, 7, 1), (2, text, 8, 2), (3, "other words", 9, 3), (3, "other words", 9, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __ROW_KEY int, gone int")
    assert sorted(tuple(r) for r in M.one_of_each(docs).collect()) == [rows[0], rows[2]]


def test_names_of_columns_do_not_clash(spark):
    same = "word after word " * 30
    rows = [(1, same, 7, "h", "t", [1]), (2, same, 8, "i", "u", [2]), (3, "short", 9, "j", "v", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __id int, __h string, __TEXT string, ___ranges array<int>")
    got = sorted(W.remove_repeats(docs, length=100, gram=40).collect())
    assert [tuple(r)[2:] for r in got] == [r[2:] for r in rows]
    assert [r.text for r in got] == ["", "", "short"]


def test_no_texts(no_docs):
    assert W.removal_report(no_docs).count() == W.remove_repeats(no_docs).count() == 0
