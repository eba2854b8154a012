"""Token operators against the tokenizers library itself."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from exactnn.llm import pow2_packing, resync_count, speculative_bpe
from exactnn.llm.pretoken import character_classes, stable_cuts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def _ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def _digest(ids):
    return hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


@pytest.fixture(scope="module")
def tool():
    return speculative_bpe.codec(PATH, character_classes(PATH))


def test_round_trip_on_odd_texts(odd_docs):
    rows = speculative_bpe.encode_round_trip(odd_docs, PATH).collect()
    texts = odd_docs.select("doc_id", "text").collect()
    want = []
    for r in texts:
        ids = _ids(r.text)
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), _digest(ids), hashlib.sha256(decoded.encode()).hexdigest()))
    key = repr
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)


def test_round_trip_on_documents(documents):
    some = documents.orderBy("doc_id").limit(200)
    texts = dict(some.select("doc_id", "text").collect())
    for row in speculative_bpe.encode_round_trip(some, PATH).collect():
        assert row.ids_sha256 == _digest(_ids(texts[row.doc_id]))
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    tool = speculative_bpe.codec(PATH, character_classes(PATH))
    data = np.frombuffer(text.encode(), np.uint8)
    ids, bounds = tool.encode(data, np.array([0, len(data)]))
    assert ids.tolist() == _ids(text)
    assert bounds.tolist() == [0, len(ids)]


def test_speculation_is_verified(tool):
    """Of words where the longest match is wrong, the pairs fail and the merges decide."""
    rng = random.Random(5)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    ids, counts = tool.model.encode_words([w.encode() for w in words])
    bounds = np.cumsum(counts)
    wrong = 0
    for word, last, count in zip(words, bounds, counts, strict=True):
        exact = tool.model._merge_long(word.encode())
        assert ids[last - count : last].tolist() == exact == _ids(word)
        data = np.frombuffer(word.encode(), np.uint8).astype(np.int64)
        greedy = tool.model._speculate(data, np.array([0]), np.array([len(data)]))[1].tolist()
        fit = tool.model._compatible(np.array(greedy[:-1], np.int64), np.array(greedy[1:], np.int64)).all()
        assert fit == (greedy == exact)
        wrong += greedy != exact
    assert wrong > 100


LONG_WORDS = [
    "supercalifragilisticexpialidocious" * 2, "ab" * 40, "Donaudampfschifffahrtselektrizitätenhauptbetriebswerkbauunterbeamtengesellschaft",
    "吾輩は猫である名前はまだ無いどこで生れたかとんと見当がつかぬ", "漢字" * 30_000,
]


@pytest.mark.parametrize("word", LONG_WORDS, ids=range(len(LONG_WORDS)))
def test_a_long_failing_word_alone(spark, tool, word):
    """Long words whose speculation fails, with no short one in the same step."""
    ids, counts = tool.model.encode_words([word.encode()])
    assert ids.tolist() == _ids(word) and counts.tolist() == [len(ids)]
    docs = spark.createDataFrame([(1, word)], "doc_id long, text string")
    trip = speculative_bpe.encode_round_trip(docs, PATH).first()
    assert (trip.n_tokens, trip.ids_sha256) == (len(ids), _digest(ids))
    assert resync_count.count_tokens(docs, PATH, chunk=64, overlap=8).first().n_tokens == len(ids)
    pieces = sorted(pow2_packing.pack(docs, PATH).collect(), key=lambda r: r.start)
    assert np.concatenate([np.frombuffer(bytes(p.ids), "<u4") for p in pieces]).tolist() == [*_ids(word), 1]


def test_counts_on_odd_texts(odd_docs):
    rows = resync_count.count_tokens(odd_docs, PATH, limit=5, chunk=64, overlap=8).collect()
    want = [
        (r.doc_id, len((r.text or "").encode()), len(_ids(r.text)), len(_ids(r.text)) > 5)
        for r in odd_docs.select("doc_id", "text").collect()
    ]
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("chunk, overlap", [(50, 4), (200, 50), (1000, 10)])
def test_chunks_are_spliced(tool, documents, chunk, overlap):
    longest = documents.selectExpr("text", "length(text) n").orderBy("n").tail(3)
    for text in [r.text for r in longest] + ["x" * 3000 + " y z " + "é" * 500, "a　'll b" * 900]:
        data = np.frombuffer(text.encode(), np.uint8)
        assert resync_count.count_huge(tool, data, chunk, overlap) == len(_ids(text))


def test_huge_text_is_cut_at_stable_places(tool, monkeypatch):
    monkeypatch.setattr(speculative_bpe, "PART_BYTES", 100)
    text = "word and another  one, it's 12 " * 50
    data = np.frombuffer(text.encode(), np.uint8)
    assert len(stable_cuts(data, 100)) > 5
    assert tool.encode(data, np.array([0, len(data)]))[0].tolist() == _ids(text)


def test_packing_keeps_every_id_once(odd_docs):
    rows = pow2_packing.pack(odd_docs.where("doc_id is not null"), PATH).collect()
    texts = odd_docs.where("doc_id is not null and doc_id <> 4").select("doc_id", "text").collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    by_doc = {}
    for r in rows:
        assert r.length & (r.length - 1) == 0 and 1 <= r.length <= 2048 and r.offset == 0
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, text in texts:
        pieces = sorted(by_doc[doc_id], key=lambda r: r.start)
        ids = np.concatenate([np.frombuffer(bytes(p.ids), "<u4") for p in pieces]).tolist()
        assert ids == [*_ids(text), 1] and pieces[0].doc_tokens == len(ids)
        assert [p.start for p in pieces] == np.cumsum([0, *[p.length for p in pieces]])[:-1].tolist()
        assert len(pieces) == len(ids) // 2048 + bin(len(ids) % 2048).count("1")
    assert len(by_doc[4]) == 3 * (bin(len(_ids("a")) + 1).count("1"))


def test_buckets_are_dense(documents):
    packed = pow2_packing.pack(documents, PATH, keep_ids=False)
    batches = pow2_packing.equal_batches(packed, 4096).collect()
    by_length = {}
    for r in batches:
        by_length.setdefault(r.length, []).append(r.sequence_id)
    for length, ids in by_length.items():
        assert sorted(ids) == [12 * i + length.bit_length() - 1 for i in range(len(ids))]
    sizes = {}
    for r in batches:
        sizes.setdefault(r.batch, []).append(r.length)
    assert all(len(set(x)) == 1 and sum(x) <= 4096 for x in sizes.values())


def test_empty_tables(no_docs):
    assert speculative_bpe.encode_round_trip(no_docs, PATH).count() == 0
    assert resync_count.count_tokens(no_docs, PATH).count() == 0
    assert pow2_packing.pack(no_docs, PATH).count() == 0
