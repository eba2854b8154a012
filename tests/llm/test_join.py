"""The n-gram join against plain loops."""

import random

import numpy as np
import pytest

from exactnn.llm import adaptive_join as J


def _shingles(text, size):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)}).split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def _links(sets, least):
    out = []
    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= least * len(x | y):
                out.append((j, i))
    return out


def _plain(rows, size=5, least=80):
    sets = [_shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in _links([s if rows[i][0] is not None else frozenset() for i, s in enumerate(sets)], least):
        parent[root(a)] = root(b)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[root(i)] = min(doc_id, smallest.get(root(i), doc_id))
    return sorted(((d, len(s), None if d is None else smallest[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def _corpus(seed, families=12, most=14, common=True):
    """Families of copies with changes about the limit, a passage that many texts hold, short and odd texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4)))
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(families):
        words = [word() for _ in range(rng.choice([3, 6, 12, 40, 120]))]
        if common and rng.random() < 0.6:
            words += passage
        for _ in range(rng.randint(1, most)):
            own = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                own[rng.randrange(len(own))] = word()
            texts.append(rng.choice([" ", "\n ", "\t"]).join(own))
    texts += [" ".join(passage), " ".join(passage).upper(), "a", "A", "a b", "", None, " \n", "é é é é é é é", texts[0], texts[0]]
    rng.shuffle(texts)
    rows = [(i if i % 19 else None, t) for i, t in enumerate(texts)]
    rows.append((5, rows[7][1]))
    rows.append(rows[9])
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, text string, id int, size int, token string").repartition(4)


def _got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components(spark, seed):
    rows = _corpus(seed)
    assert _got(J.ngram_components(_frame(spark, rows))) == _plain(rows)


def test_small_cells_and_ranges(spark, monkeypatch):
    """Many ranges that forget, small cells, no broadcast, counters in which shingles collide."""
    monkeypatch.setattr(J, "FAN_IN", 2)
    limits = J.Limits(1 << 10, 50, 300, 20, 3, 3, 2, 0)
    rows = _corpus(4)
    found = J.ngram_components(_frame(spark, rows), shingle_words=3, least=60, limits=limits)
    assert _got(found) == _plain(rows, 3, 60)


def test_all_links(spark):
    rows = [r for r in _corpus(5) if r[0] is not None]
    links, members = J.ngram_links(_frame(spark, rows))
    of = {}
    for r in members.collect():
        of.setdefault(r.class_id, set()).add(r.doc_id)
    got = {frozenset((a, b)) for r in links.collect() for a in of[r.a_id] for b in of[r.b_id]}
    got |= {frozenset((a, b)) for own in of.values() for a in own for b in own if a != b}
    sets = [_shingles(t, 5) for _, t in rows]
    want = {frozenset((rows[a][0], rows[b][0])) for a, b in _links(sets, 80)}
    assert got | {frozenset((r[0],)) for r in rows} == want | {frozenset((r[0],)) for r in rows}


@pytest.mark.parametrize("least", [50, 80])
def test_large_buckets_in_small_cells(spark, least):
    """Every bucket of three classes or more is screened by bitmaps, in cells of a few classes."""
    limits = J.Limits(cell=4, grid=3, counted=2)
    rows = _corpus(6)
    assert _got(J.ngram_components(_frame(spark, rows), 3, least, limits=limits)) == _plain(rows, 3, least)
    rows = [r for r in rows if r[0] is not None]
    some, others = (J.ngram_links(_frame(spark, rows), 3, least, limits=own) for own in (limits, J.Limits(counted=10**6)))
    assert some[0].count() == others[0].count() > 50


def test_bitmaps_lose_no_link():
    """Whatever their bitmaps, two sets that link pass the screen."""
    rng = np.random.default_rng(3)
    for least in (40, 80):
        for _ in range(300):
            n, more, less = int(rng.integers(1, 6000)), int(rng.integers(0, 400)), int(rng.integers(0, 400))
            both = rng.integers(0, 1 << 63, n).astype(np.uint64)
            x = np.unique(np.concatenate([both, rng.integers(0, 1 << 63, more).astype(np.uint64)]))
            y = np.unique(np.concatenate([both, rng.integers(0, 1 << 63, less).astype(np.uint64)]))
            cells = [J._Cell(J.pa.table({"id": [i], "component": [i], "size": [len(s)], "l": [1], "lam": [1], "bits": [J.bitmap(s)]})) for i, s in enumerate((x, y))]
            passed = any((likeness > 0).any() for _, _, likeness in J.screened(*cells, least))
            assert passed or 100 * len(np.intersect1d(x, y)) < least * len(np.union1d(x, y))


def test_a_large_group_of_near_copies_compares_few_pairs(spark, monkeypatch):
    """Copies that are like their original and little like each other: most pairs share a prefix, few link."""
    rng = random.Random(9)
    original = [str(rng.randrange(10**6)) for _ in range(150)]
    rows = [(0, " ".join(original))]
    for i in range(1, 300):
        own = list(original)
        for at in rng.sample(range(len(own)), rng.choice([2, 3, 4, 5])):
            own[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    compared, confirmed = [], J._Join.confirmed
    monkeypatch.setattr(J._Join, "confirmed", lambda self, pairs, name: compared.append(pairs.count()) or confirmed(self, pairs, name))
    assert _got(J.ngram_components(_frame(spark, rows))) == _plain(rows)
    assert sum(compared) < 10 * len(rows)  # of 44,850 pairs


def test_prefixes_lengthen_where_shingles_are_frequent():
    """Under any order and any numbers of matches, linked sets match often enough; hot prefixes ask for more."""
    rng = np.random.default_rng(1)
    codes = rng.integers(1, 5, 1 << 10).astype(np.uint8)
    codes[: 1 << 7] = 0
    further = 10 * 2.0 ** np.arange(256).clip(0, 20)
    further[0] = 0
    grown = 0
    for _ in range(400):
        n = int(rng.integers(1, 200))
        both = rng.integers(0, 1 << 63, n).astype(np.uint64)
        x = np.unique(np.concatenate([both, rng.integers(0, 1 << 63, int(rng.integers(0, n // 8 + 1))).astype(np.uint64)]))
        y = np.unique(np.concatenate([both, rng.integers(0, 1 << 63, int(rng.integers(0, n // 8 + 1))).astype(np.uint64)]))
        if 100 * len(np.intersect1d(x, y)) < 80 * len(np.union1d(x, y)):
            continue
        (p, k), (q, l) = (J.adaptive_prefix(s, codes, further) for s in (x, y))
        lam = lambda own, prefix: {t: max(1, i + 1 - (len(own) - (80 * len(own) + 99) // 100)) for i, t in enumerate(prefix.tolist())}
        at_x, at_y = lam(x, p), lam(y, q)
        low = min(k, l)
        assert sum(max(at_x[t], at_y[t]) <= low for t in at_x.keys() & at_y.keys()) >= low
        assert len(p) <= len(x) and 1 <= k <= J.MOST_MATCHES
        grown += k > 1
    assert grown > 50
    cold = np.zeros(1 << 10, np.uint8)
    assert J.adaptive_prefix(x, cold, further)[1] == 1


def test_common_passages_stay_out_of_prefixes(spark):
    """A passage in many different texts brings no two of them together."""
    rng = random.Random(8)
    word = lambda: str(rng.randrange(10**6))
    passage = " ".join(word() for _ in range(60))
    rows = [(i, " ".join(word() for _ in range(100)) + " " + passage) for i in range(300)]
    job = J._Join(_frame(spark, rows), 5, 80, "doc_id", "text")
    assert job.entries.count() < 300  # of some 16,000 shingles of the passage
    assert _got(J.ngram_components(_frame(spark, rows))) == _plain(rows)


def test_no_rows(no_docs):
    assert J.ngram_components(no_docs).count() == 0
    assert [df.count() for df in J.ngram_links(no_docs)] == [0, 0]
