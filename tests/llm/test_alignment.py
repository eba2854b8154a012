"""Token alignment against the libraries and plain loops."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from exactnn.llm import token_alignment as T
from exactnn.llm.queries import op13_token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


class Plain:
    """Token by token, from the libraries themselves."""

    def __init__(self):
        from exactnn.llm.speculative_bpe import _unicode_of_byte

        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.byte = {c: b for b, c in enumerate(_unicode_of_byte())}

    def tokens(self, text):
        if not text:
            return [], []
        ids = self.a.encode(" " + text, add_special_tokens=False).ids
        a = [(i, bytes(self.byte[c] for c in self.a.id_to_token(i))) for i in ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        want = (" " + text).encode()
        if b"".join(t for _, t in a) != want or b"".join(t for _, t in b) != want:
            return [], []
        return a, b

    def one(self, text):
        a, b = self.tokens(text)
        spans = []
        for side in (a, b):
            at, own = 0, []
            for i, t in side:
                own.append((i, at, at + len(t)))
                at += len(t)
            spans.append(own)
        links = []
        j0 = 0
        for i, s, e in spans[0]:
            while j0 < len(spans[1]) and spans[1][j0][2] <= s:
                j0 += 1
            j = j0
            while j < len(spans[1]) and spans[1][j][1] < e:
                links.append((i, spans[1][j][0]))
                j += 1
        common = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, at = [], [0, 0]
        for end in common:
            sides = []
            for k, own in enumerate(spans):
                first = at[k]
                while at[k] < len(own) and own[at[k]][2] <= end:
                    at[k] += 1
                sides.append(",".join(str(i) for i, *_ in own[first : at[k]]))
            groups.append("|".join(sides))
        return len(a), len(b), len(common), links, ";".join(groups)

    def all(self, texts):
        found = [self.one(t) for t in texts]
        count = Counter(x for *_, links, _ in found for x in links)
        best = {}
        for (_, b), n in count.items():
            best[b] = max(best.get(b, 0), n)
        return [
            (
                n_a, n_b, n_groups, len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
                hashlib.sha256(s.encode()).hexdigest() if n_a else "",
            )
            for n_a, n_b, n_groups, links, s in found
        ]


@pytest.fixture(scope="module")
def plain():
    return Plain()


def _got(df):
    return sorted(((r.doc_id, *[r[n] for n in NAMES]) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    marks = list("ab \n\t 1é漢 字") + ["<|endoftext|>", "<s>", "<0x41>", "😀", "\x00", "the ", "  ", "====", "naïve", "­", "ﬁ", "é"]
    made = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 30))) for _ in range(250)]
    return [
        None, "", " ", "  ", "a ", "▁", "x▁y", "漢字" * 300, "don't  stop", "same text", "same text", *made,
    ]


@pytest.mark.parametrize("limit", [1 << 26, 6000])
def test_against_the_libraries(spark, plain, texts, limit, monkeypatch):
    monkeypatch.setattr(T, "FAN_IN", 2)
    rows = [(i if i % 40 else None, t, 1, 2, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int, keys int, n_a string").repartition(3)
    want = sorted(((r[0], *p) for r, p in zip(rows, plain.all(texts), strict=True)), key=repr)
    assert _got(T.align(docs, A, B, broadcast_bytes=limit)) == want


def test_query_on_documents(spark, sf, plain, documents):
    rows = documents.select("doc_id", "text").orderBy("doc_id").collect()
    want = sorted(((r.doc_id, *p) for r, p in zip(rows, plain.all([r.text for r in rows]), strict=True)), key=repr)
    assert _got(op13_token_alignment(spark, sf)) == want


def test_links_and_shared_groups(spark, plain, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    digest = {r.doc_id: r for r in T.align(docs, A, B).collect()}
    links = Counter(r.doc_id for r in T.token_links(docs, A, B).collect())
    shared = Counter(r.doc_id for r in T.token_links(docs, A, B, "group").collect())
    for i, r in digest.items():
        assert (links[i], shared[i]) == (r.n_links, r.n_shared)
    for r in T.token_links(docs.where("doc_id = 8"), A, B).collect():
        a, b = plain.tokens(texts[8])
        assert (a[r.a_pos][0], b[r.b_pos][0]) == (r.a_id, r.b_id) and r.weight >= 1


def test_products_in_blocks():
    rng = np.random.default_rng(3)
    for _ in range(40):
        dense_a, dense_b = rng.random((6, 9)) < 0.3, rng.random((9, 5)) < 0.3
        csr = [T.Csr(np.concatenate([[0], np.cumsum(m.sum(axis=1))]), np.nonzero(m)[1]) for m in (dense_a, dense_b)]
        i, j, v = T.csr_product(*csr)
        out = np.zeros((6, 5), int)
        out[i, j] = v
        assert (out == dense_a.astype(int) @ dense_b.astype(int)).all() and (v > 0).all()
        total = int(rng.integers(1, 60))
        sides = []
        for _ in range(2):
            ends = np.unique(np.append(rng.integers(1, total + 1, 12), total))
            sides.append(np.diff(np.concatenate([[0], ends])))
        whole = [np.concatenate(x).tolist() for x in zip(*T.overlap_links(*sides), strict=True)]
        parts = [np.concatenate(x).tolist() for x in zip(*T.overlap_links(*sides, block=5), strict=True)]
        assert whole == parts and sum(whole[2]) == total
        groups = T.groups_of(*sides)
        whole = [np.concatenate(x).tolist() for x in zip(*T.shared_group_links(*groups), strict=True)]
        parts = [np.concatenate(x).tolist() for x in zip(*T.shared_group_links(*groups, block=3), strict=True)]
        assert whole == parts == [*map(list, zip(*[(a, b, 1) for a, x in enumerate(groups[0]) for b, y in enumerate(groups[1]) if x == y], strict=True))]


def test_no_rows(no_docs):
    assert T.align(no_docs, A, B).count() == 0 and T.token_links(no_docs, A, B).count() == 0
