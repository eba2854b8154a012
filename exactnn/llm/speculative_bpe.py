"""BPE encoding and decoding: speculate with greedy longest matches, verify every adjacent pair.

A sequence of tokens is the byte-pair encoding of its bytes exactly if each two neighbours are the
encoding of their joint bytes. So the tokens of a pre-token are guessed by greedy longest match,
for all pre-tokens of a step at once on a trie in arrays; whether two tokens can stand together
is decided from the merge trees along their common edge, once for each distinct pair; and only
pre-tokens with a pair that fails are merged step by step.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from exactnn.llm.arrow import id_and_text, mix, ragged, slices, text_buffer
from exactnn.llm.pretoken import (
    PreTokenizer,
    WordMemo,
    character_classes,
    special_tokens,
    stable_cuts,
)

_NONE = -1
#: Larger than any merge's rank.
_NEVER = np.int64(1) << 40
#: Failing pre-tokens of more bytes are merged one by one, the others side by side.
LONG_WORD = 48
#: Bytes of one text that are encoded in one step.
PART_BYTES = 4 << 20


class _Table:
    """A fixed map from non-negative integers to integers, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        size = 1 << max(4, int(np.ceil(np.log2(4 * max(1, len(keys))))))
        self._mask = np.uint64(size - 1)
        self._keys = np.full(size, -1, np.int64)
        self._values = np.full(size, _NONE, np.int64)
        slot = self._slot(keys)
        open_ = np.arange(len(keys))
        self._probes = 0
        while len(open_):
            self._probes += 1
            free = open_[self._keys[slot[open_]] < 0]
            self._keys[slot[free]] = keys[free]  # of several, the last one stays
            won = free[self._keys[slot[free]] == keys[free]]
            self._values[slot[won]] = values[won]
            open_ = np.setdiff1d(open_, won, assume_unique=True)
            slot[open_] = (slot[open_] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) & self._mask).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        out = np.full(len(keys), _NONE, np.int64)
        open_ = np.arange(len(keys))
        for _ in range(self._probes):
            held = self._keys[slot]
            hit = held == keys[open_]
            out[open_[hit]] = self._values[slot[hit]]
            go = ~hit & (held >= 0)
            if not go.any():
                break
            open_ = open_[go]
            slot = (slot[go] + 1) & np.int64(self._mask)
        return out


def _unicode_of_byte() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


class SpeculativeBpe:
    """The model of a byte-level BPE file: vocabulary, merge trees and their lookup tables."""

    def __init__(self, path: str):
        with open(path) as file:
            model = json.load(file)["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix"):
            raise ValueError("only a plain byte-level BPE model is supported")
        if model.get("end_of_word_suffix") or model.get("ignore_merges"):
            raise ValueError("only a plain byte-level BPE model is supported")
        byte_of = {c: b for b, c in enumerate(_unicode_of_byte())}
        vocab: dict[str, int] = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        size = max(vocab.values()) + 1
        self.bytes: list[bytes] = [b""] * size
        for word, token in vocab.items():
            if all(c in byte_of for c in word):
                self.bytes[token] = bytes(byte_of[c] for c in word)
        self.byte_token = np.array([vocab[c] for c in _unicode_of_byte()], np.int64)
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        if len(np.unique(made)) != len(made):
            raise ValueError("a token is made by two merges")
        self._size = size
        self._left = np.full(size, _NONE, np.int64)
        self._right = np.full(size, _NONE, np.int64)
        self._rank = np.full(size, -1, np.int64)
        self._left[made], self._right[made] = left, right
        self._rank[made] = np.arange(len(made))
        self._made = made
        self._pair_rank = _Table(left * size + right, np.arange(len(made)))
        self._merges = {(a, b): (r, m) for r, (a, b, m) in enumerate(zip(left.tolist(), right.tolist(), made.tolist(), strict=True))}
        self._build_trie([*self.byte_token.tolist(), *self._own_encoding(made)])
        self._known: _Pairs = _Pairs(self._compatible, size)

    def _own_encoding(self, made: np.ndarray) -> list[int]:
        """Tokens that are the encoding of their own bytes: both halves are and fit together."""
        alright = np.zeros(self._size, bool)
        alright[self.byte_token] = True
        fits = np.zeros(self._size, bool)
        # the halves meet only by this very merge: nothing earlier joins them across the edge
        fits[made] = self._compatible(self._left[made], self._right[made], self._rank[made])
        for token in made.tolist():  # in the order of merges, halves first
            alright[token] = alright[self._left[token]] and alright[self._right[token]] and fits[token]
        return [t for t in made.tolist() if alright[t]]

    def _build_trie(self, tokens: list[int]) -> None:
        """Children by node * 256 + byte; the token that ends at each node."""
        nodes: dict[int, int] = {}
        accept = [_NONE]
        for token in tokens:
            node = 0
            for byte in self.bytes[token]:
                key = node * 256 + byte
                node = nodes.get(key, 0)
                if not node:
                    node = nodes[key] = len(accept)
                    accept.append(_NONE)
            accept[node] = token
        self._child = _Table(np.fromiter(nodes.keys(), np.int64), np.fromiter(nodes.values(), np.int64))
        self._accept = np.array(accept, np.int64)

    def _compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge joins a token ``a`` and the token ``b`` after it, or their parts.

        Going back in time from the finished tokens, the part at the edge that was made last is
        undone first. Two parts that met would have been joined if their merge comes before the
        merges that took either of them away: strictly before that of the left one, which an
        equal merge further left uses up first. ``before``: only merges before this rank count.
        """
        a, b = a.copy(), b.copy()
        fits = np.ones(len(a), bool)
        until_a = np.full(len(a), _NEVER) if before is None else before.astype(np.int64)
        until_b = np.full(len(a), _NEVER) if before is None else before.astype(np.int64) - 1
        open_ = np.arange(len(a))
        while len(open_):
            x, y = a[open_], b[open_]
            rank = self._pair_rank.get(x * self._size + y)
            joined = (rank >= 0) & (rank < until_a[open_]) & (rank <= until_b[open_])
            fits[open_[joined]] = False
            rank_x, rank_y = self._rank[x], self._rank[y]
            go = ~joined & ((rank_x >= 0) | (rank_y >= 0))
            open_, x, y, rank_x, rank_y = open_[go], x[go], y[go], rank_x[go], rank_y[go]
            undo = rank_x > rank_y
            at = open_[undo]
            until_a[at], a[at] = rank_x[undo], self._right[x[undo]]
            at = open_[~undo]
            until_b[at], b[at] = rank_y[~undo], self._left[y[~undo]]
        return fits

    def _merge_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pre-tokens by their merges: in each round, every word's earliest one."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ids = self.byte_token[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        rank = np.full(len(ids), _NEVER)  # of the pair that begins here, inside a word
        pair = np.flatnonzero(owner[1:] == owner[:-1])
        rank[pair] = self._ranks(ids[pair], ids[pair + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sizes = np.diff(np.append(heads, len(ids)))
            least = np.minimum.reduceat(rank, heads)
            ended = np.repeat(least >= _NEVER, sizes)
            at = np.flatnonzero((rank == np.repeat(least, sizes)) & ~ended)
            at = at[np.append(True, owner[at[1:]] != owner[at[:-1]])] if len(at) else at
            ids[at] = self._made[rank[at]]
            keep = ~ended
            keep[at + 1] = False
            done.append((owner[ended], ids[ended]))
            place = (np.cumsum(keep) - 1)[at]
            owner, ids, rank = owner[keep], ids[keep], rank[keep]
            for first in (place[place > 0] - 1, place):
                rank[first] = _NEVER
                first = first[first + 1 < len(ids)]
                first = first[owner[first] == owner[first + 1]]
                rank[first] = self._ranks(ids[first], ids[first + 1])
        none = np.zeros(0, np.int64)  # words may all be empty
        owner = np.concatenate([none, *[o for o, _ in done]])
        order = np.argsort(owner, kind="stable")
        return np.concatenate([none, *[i for _, i in done]])[order], np.bincount(owner, minlength=len(words))

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        rank = self._pair_rank.get(a * self._size + b)
        return np.where(rank < 0, _NEVER, rank)

    def _merge_long(self, word: bytes) -> list[int]:
        """The same for one long pre-token, with a queue of merges."""
        ids = self.byte_token[np.frombuffer(word, np.uint8)].tolist()
        after = [*range(1, len(ids)), _NONE]
        prior = list(range(-1, len(ids) - 1))
        merges = self._merges
        queue = []
        for i in range(len(ids) - 1):
            found = merges.get((ids[i], ids[i + 1]))
            if found:
                queue.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapq.heapify(queue)
        while queue:
            _, i, x, y, made = heapq.heappop(queue)
            j = after[i]
            if ids[i] != x or j < 0 or ids[j] != y:
                continue
            ids[i], ids[j] = made, _NONE
            k = after[i] = after[j]
            if k >= 0:
                prior[k] = i
                found = merges.get((made, ids[k]))
                if found:
                    heapq.heappush(queue, (found[0], i, made, ids[k], found[1]))
            h = prior[i]
            if h >= 0:
                found = merges.get((ids[h], made))
                if found:
                    heapq.heappush(queue, (found[0], h, ids[h], made, found[1]))
        return [t for t in ids if t >= 0]

    def _speculate(self, data: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, token) of greedy longest matches, in order."""
        words, tokens = [], []
        active = np.arange(len(first))
        at = first.copy()
        while len(active):
            node = np.zeros(len(active), np.int64)
            best = np.full(len(active), _NONE, np.int64)
            length = np.zeros(len(active), np.int64)
            walk = np.arange(len(active))
            depth = 0
            while len(walk):
                node_now = self._child.get(node[walk] * 256 + data[at[active[walk]] + depth])
                depth += 1
                alive = node_now > 0
                walk, node_now = walk[alive], node_now[alive]
                node[walk] = node_now
                ends = self._accept[node_now]
                hit = ends >= 0
                best[walk[hit]], length[walk[hit]] = ends[hit], depth
                walk = walk[at[active[walk]] + depth < last[active[walk]]]
            words.append(active)
            tokens.append(best)
            at[active] += length
            active = active[at[active] < last[active]]
        words, tokens = np.concatenate(words), np.concatenate(tokens)
        order = np.argsort(words, kind="stable")
        return words[order], tokens[order]

    def _exact(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        short = [w if len(w) <= LONG_WORD else b"" for w in words]
        ids, counts = self._merge_all(short)
        if not all(short):
            long = [i for i, w in enumerate(short) if not w]
            merged = [self._merge_long(words[i]) for i in long]
            at = np.cumsum(counts)[long]
            counts[long] = [len(m) for m in merged]
            ids = np.insert(ids, np.repeat(at, counts[long]), [t for m in merged for t in m])
        return ids, counts

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pre-tokens, flat, and how many each has. An empty word has none."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        last = np.cumsum(lengths)
        filled = np.flatnonzero(lengths)
        if not len(filled):
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        owner, tokens = self._speculate(data, (last - lengths)[filled], last[filled])
        owner = filled[owner]
        same = owner[1:] == owner[:-1]
        fits = np.ones(len(same), bool)
        fits[same] = self._known.get(tokens[:-1][same], tokens[1:][same])
        failed = np.unique(owner[1:][~fits])
        counts = np.bincount(owner, minlength=len(words))
        if len(failed):
            exact, found = self._exact([words[i] for i in failed.tolist()])
            counts[failed] = found
            out = np.empty(int(counts.sum()), np.int64)
            begin = np.cumsum(counts) - counts
            redo = np.zeros(len(words), bool)
            redo[failed] = True
            keep = np.flatnonzero(~redo)
            out[ragged(begin[keep], counts[keep])] = tokens[~redo[owner]]
            out[ragged(begin[failed], found)] = exact
            tokens = out
        return tokens.astype(np.int32), counts


class _Pairs:
    """Remembers which pairs fit, in a table of fixed size that newer pairs overwrite."""

    def __init__(self, ask, size: int, bits: int = 18):
        self._ask, self._size = ask, size
        self._mask = np.uint64((1 << bits) - 1)
        self._keys = np.full(1 << bits, -1, np.int64)
        self._fits = np.zeros(1 << bits, bool)

    def get(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys, codes = np.unique(a * self._size + b, return_inverse=True)
        slot = (mix(keys.astype(np.uint64)) & self._mask).astype(np.int64)
        fits = self._fits[slot]
        new = np.flatnonzero(self._keys[slot] != keys)
        if len(new):
            fits[new] = self._ask(keys[new] // self._size, keys[new] % self._size)
            _, one = np.unique(slot[new], return_index=True)  # one pair for each slot
            kept = new[one]
            self._keys[slot[kept]], self._fits[slot[kept]] = keys[kept], fits[kept]
        return fits[codes]


class Codec:
    """Whole texts to ids and back."""

    def __init__(self, path: str, classes: bytes, special: bool = True):
        self.special = special_tokens(path) if special else {}
        self.model = SpeculativeBpe(path)
        self.split = PreTokenizer(classes, list(self.special))
        self.memo = WordMemo(self._words)
        size = max([len(self.model.bytes) - 1, *self.special.values()]) + 1
        table = [*self.model.bytes, *[b""] * (size - len(self.model.bytes))]
        for text, token in self.special.items():
            table[token] = text
        self._length = np.fromiter(map(len, table), np.int64, size)
        self._first = np.cumsum(self._length) - self._length
        self._data = np.frombuffer(b"".join(table), np.uint8)

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        own = [i for i, w in enumerate(words) if w in self.special] if self.special else []
        if not own:
            return self.model.encode_words(words)
        ids, counts = self.model.encode_words([b"" if w in self.special else w for w in words])
        at = (np.cumsum(counts) - counts)[own]
        counts[own] = 1
        return np.insert(ids, at, [self.special[words[i]] for i in own]), counts

    def encode(self, data: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in ``data``, flat, and the len + 1 bounds of each text's ids.

        ``texts``: len + 1 ascending offsets. A huge text is cut where no pre-token crosses.
        """
        if len(data) > PART_BYTES and len(texts) == 2:
            cuts = [*stable_cuts(data, PART_BYTES).tolist(), len(data)]
            parts = [self._encode(data[a:b], np.array([0])) for a, b in zip(cuts, cuts[1:], strict=False)]
            ids = np.concatenate([p[0] for p in parts])
            return ids, np.array([0, len(ids)])
        ids, starts, total = self._encode(data, texts[:-1])
        return ids, total[np.searchsorted(starts, texts)]

    def _encode(self, data, segments):
        starts = self.split.starts(data, segments)
        rows = self.memo.rows(data, starts)
        total = np.concatenate([[0], np.cumsum(self.memo.counts(rows))])
        return self.memo.ids(rows), starts, total

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids in UTF-8; bytes that are no UTF-8 become U+FFFD, as in the library."""
        raw = self._data[ragged(self._first[ids], self._length[ids])].tobytes()
        try:
            raw.decode()
            return raw
        except UnicodeDecodeError:
            return raw.decode(errors="replace").encode()


@functools.lru_cache(maxsize=2)
def codec(path: str, classes: bytes, special: bool = True) -> Codec:
    """One codec per worker and file. Without ``special``, special strings are plain text."""
    return Codec(path, classes, special)


def encode_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of ``docs``.

    The ids are those of the tokenizers library without added special tokens, truncation or
    padding; special strings inside a text become their one id. ``ids_sha256`` is over
    little-endian unsigned 32-bit ids, ``decoded_sha256`` over the UTF-8 of the decoded text.
    Null and empty texts have no ids and decode to nothing; rows with equal or null ids and other
    columns are each taken as they are, also repeated rows; an empty table gives an empty one. Memory: one Arrow batch, and some 30 bytes per byte of a
    step of at most 4 MiB unless a text has no letter-space-letter in that length.
    """
    classes = character_classes(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, classes)
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            tokens, id_hash, text_hash = [], [], []
            for first, last in slices(offsets):
                texts = offsets[first : last + 1] - offsets[first]
                ids, bounds = tool.encode(data[offsets[first] : offsets[last]], texts)
                raw = ids.astype("<u4").tobytes()
                for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
                    tokens.append(b - a)
                    id_hash.append(hashlib.sha256(raw[4 * a : 4 * b]).hexdigest())
                    text_hash.append(hashlib.sha256(tool.decode(ids[a:b])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(tokens, pa.int64()), pa.array(id_hash, pa.string()), pa.array(text_hash, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
