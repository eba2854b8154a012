"""Quality operators: plain counts, gradients, held-out accuracy."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from exactnn.llm import byte_cnn as B
from exactnn.llm import decision_list as D
from exactnn.llm.queries import op1_quality, op8_quality_rules
from exactnn.session import materialize


def _held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


# --- decision lists --------------------------------------------------------------------------------


def _plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    inside = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(8)}
    n = len(words)
    failed = n < 20 or 100 * len(inside) > 30 * n
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), failed


def test_counts(spark, odd_docs, documents):
    words = "one two three four five six seven eight nine ten".split()
    made = [" ".join(words * 3), " ".join(words[:8]), " ".join(words[:8] * 2), "a " * 9, "a " * 8, "\n".join(["x y", " ", "x y", "", "x y "] * 2), "a\x1cb\x85c d e#*|<>"]
    docs = odd_docs.select("doc_id", "text").unionByName(documents.select("doc_id", "text").limit(300))
    docs = docs.unionByName(spark.createDataFrame([(9000 + i, t) for i, t in enumerate(made)], "doc_id long, text string"))
    rows = D.apply_rules(D.statistics(docs), []).collect()
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows]
    assert sorted(got, key=repr) == sorted(((r.doc_id, *_plain(r.text)) for r in docs.collect()), key=repr)
    assert all(r.kept == (not r.base_failed) for r in rows)


def test_rules_hold_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = dict(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect())
    rows = [r for r in op8_quality_rules(spark, sf).collect() if r.doc_id in labels and _held(r.doc_id)]
    good = [r for r in rows if labels[r.doc_id] == 1 and not r.base_failed]
    bad = [r for r in rows if labels[r.doc_id] == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(r.kept for r in bad) <= 0.1 * len(bad)


def _features(text):
    """The features of a text, counted with plain loops."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, chars, symbols, dup_lines, repeated, _ = _plain(text)
    share = lambda a, b: a / max(b, 1)
    count = lambda pattern: len(re.findall(pattern, text))
    return {
        "n_words": n, "mean_word": share(chars, n), "symbol_share": share(symbols, chars),
        "dup_line_share": share(dup_lines, len(lines)), "repeat_share": share(repeated, n),
        "distinct_share": share(len(set(words)), n), "upper_share": share(count("[A-Z]"), chars),
        "mark_share": share(count("[!?]"), chars), "digit_share": share(count("[0-9]"), chars), "words_per_line": share(n, len(lines)),
    }


def test_verdicts_against_plain_rules(spark, sf, documents, odd_docs):
    """Every row's verdict, from the learned rules and plainly counted features."""
    docs = documents.select("doc_id", "text").unionByName(odd_docs.selectExpr("doc_id + 100000 as doc_id", "text"))
    counted = materialize(D.statistics(docs), "counted")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rules = D.learn(counted.join(labels.select("doc_id", "quality"), "doc_id"))
    assert rules and {c.feature for r in rules for c in r.conditions} <= set(_features(""))
    want = []
    for r in docs.collect():
        own = _features(r.text)
        hit = any(all((own[c.feature] > c.threshold) == c.above for c in rule.conditions) for rule in rules)
        want.append((r.doc_id, not _plain(r.text)[-1] and not hit))
    got = [(r.doc_id, r.kept) for r in D.apply_rules(counted, rules).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert len({k for _, k in got}) == 2


def test_rules_are_learned_pruned_and_ordered(spark):
    rows = []
    for i in range(900):
        bad = i % 3 == 0
        rows.append((i, 100, 5.0, 0.5 if bad and i % 2 else 0.0, 0.0, 0.9 if bad and not i % 2 else 0.0, 0.9, 0.0, 0.0, 0.0, 10.0, int(not bad)))
    names = ["doc_id", *D.FEATURES, "quality"]
    rules = D.learn(materialize(spark.createDataFrame(rows, names), "rows"))
    assert len(rules) == 2 and {r.conditions[0].feature for r in rules} == {"symbol_share", "repeat_share"}
    assert all(len(r.conditions) == 1 and r.good == 0 for r in rules)
    text = str(D.verdict(rules))
    assert text.index(rules[0].conditions[0].feature) < text.index(rules[1].conditions[0].feature)


def test_no_python_in_the_plan(spark, documents):
    plan = D.statistics(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(None, 0), (1, None)]])
def test_without_two_classes_there_are_no_rules(spark, odd_docs, no_docs, labels):
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    rows = D.quality_rules(odd_docs, known).collect()
    assert len(rows) == odd_docs.count() and all(r.kept == (not r.base_failed) for r in rows)
    assert D.quality_rules(no_docs, known).count() == 0
    scored = B.score_quality(odd_docs, known).collect()
    assert len(scored) == len(rows) and len({r.score for r in scored}) == 1
    assert B.score_quality(no_docs, known).count() == 0


# --- network ---------------------------------------------------------------------------------------


def _batch(texts):
    return B.padded(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))


def test_gradients():
    net = B.Network.start(np.random.default_rng(0))
    for name, value in vars(net).items():
        setattr(net, name, value.astype(np.float64))
    symbols, bounds = _batch([b"some text " * 90, b"", b"other, LONGER text 123 " * 60, b"x"])
    label = np.array([1.0, 0.0, 0.0, 1.0])

    def loss():
        values = B.convolve(net, np.concatenate([symbols, np.full(4, B.PAD, np.int16)]), bounds[1:] * 32 - 1)[:-1]
        maxima = np.maximum(values.reshape(-1, 32, B.FILTERS).max(axis=1), 0)
        p = B._probability(net, B.pool(maxima, bounds)[2])[1]
        return -np.mean(label * np.log(p) + (1 - label) * np.log(1 - p))

    for value, gradient in zip(net.parameters(), B._gradients(net, symbols, bounds, label), strict=True):
        at = np.unravel_index(np.argmax(np.abs(gradient)), gradient.shape)
        kept, step = value[at], 1e-5
        value[at] = kept + step
        above = loss()
        value[at] = kept - step
        below = loss()
        value[at] = kept
        assert (above - below) / 2 / step == pytest.approx(gradient[at], rel=1e-3)


def test_a_score_depends_on_its_whole_text_only(monkeypatch):
    net = B.Network.start(np.random.default_rng(3))
    texts = [b"abc " * 40_000, b"", b"tail", b"z" * 511, b"y" * 124, b"y" * 125]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    together = B.predict(net, data, offsets)
    alone = [B.predict(net, np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert together == pytest.approx(alone, abs=1e-6)
    monkeypatch.setattr(B, "_STEP_BLOCKS", 3)
    assert B.predict(net, data, offsets) == pytest.approx(together, abs=1e-6)
    changed = texts[0][:-3] + b"$$$"
    assert B.predict(net, np.frombuffer(changed, np.uint8), np.array([0, len(changed)]))[0] != alone[0]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = dict(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect())
    rows = op1_quality(spark, sf).collect()
    assert len(rows) == 10_000 and all(r.held_out == _held(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)
    known = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == q for p, q in known) >= 0.96 * len(known)
    good = [p for p, q in known if q == 1]
    assert sum(good) >= 0.98 * len(good)


def test_odd_rows_are_scored(spark, odd_docs):
    known = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    rows = B.score_quality(odd_docs, known, epochs=1).collect()
    assert len(rows) == odd_docs.count()
    empty = {r.score for r, t in zip(rows, odd_docs.select("text").collect(), strict=True) if not t.text}
    assert len(empty) == 1


def _plain_score(net, data):
    """One text, position by position: filters over two groups of bytes, chunk maxima, the layers."""
    blocks = -(-(len(data) + B.STRIDE) // B.BLOCK_BYTES)
    symbols = list(data) + [B.PAD] * (blocks * B.BLOCK_BYTES - len(data))
    groups = [np.concatenate([net.embed[s] for s in symbols[i : i + B.STRIDE]]) for i in range(0, len(symbols), B.STRIDE)]
    values = [a @ net.filters[0] + b @ net.filters[1] for a, b in zip(groups, groups[1:], strict=False)] + [np.zeros(B.FILTERS)]
    per_block = B.BLOCK_BYTES // B.STRIDE
    chunks, at = [], 0
    while True:
        part = values[at * per_block : (at + B.CHUNK_BLOCKS) * per_block]
        chunks.append(np.maximum(np.max(part, axis=0), 0))
        if at + B.CHUNK_BLOCKS >= blocks:
            break
        at += B.HOP_BLOCKS
    features = np.concatenate([np.max(chunks, axis=0), np.mean(chunks, axis=0), np.min(chunks, axis=0)])
    hidden = np.tanh(features @ net.hidden + net.hidden_bias)
    return 1 / (1 + np.exp(-np.clip(hidden @ net.out + net.out_bias[0], -30, 30)))


def test_scores_against_a_plain_forward_pass(odd_texts, documents):
    """Whole texts, from empty to some that are many steps long."""
    net = B.Network.start(np.random.default_rng(3))
    texts = [(t or "").encode() for t in [*odd_texts[:40], "some words! " * 12_000]]
    texts += [r.text.encode() for r in documents.orderBy("doc_id").limit(20).collect()]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = B.predict(net, np.frombuffer(b"".join(texts), np.uint8), offsets)
    assert np.allclose(got, [_plain_score(net, t) for t in texts], atol=1e-4)
