"""Byte-level pre-tokens with numpy, and a memo from pre-tokens to ids.

A byte-level BPE works on one pre-token at a time, so a text's ids are those of its pre-tokens.
Texts repeat their pre-tokens: each distinct one of a step is encoded once, the rest is lookups.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd

from exactnn.llm.arrow import ragged, span_hashes

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: Code points above this that are letters, numbers or white space do not exist but for planes
#: without any; the probe covers all below.
_PROBED = 0x40000
#: Pre-tokens a worker remembers; the memo starts anew beyond that, which changes no result.
MEMO_WORDS = 400_000


@functools.lru_cache(maxsize=4)
def character_classes(path: str) -> bytes:
    """One byte per code point, compressed: the class that the tokenizer at ``path`` gives it.

    Asked of the library itself, so that both follow one version of Unicode: a character that
    stays with "a" is a letter, with "1" a number, with "!" neither; the rest is white space.
    """
    from tokenizers import Tokenizer

    with open(path) as file:
        kind = json.load(file)["pre_tokenizer"] or {}
    if kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or not kind["use_regex"]:
        raise ValueError("only byte-level tokenizers without a prefix space are supported")
    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    points = [p for p in range(_PROBED) if not 0xD800 <= p < 0xE000 and p != 10]
    classes = np.full(_PROBED, SPACE, np.uint8)
    for mark, found in (("a", LETTER), ("1", NUMBER), ("!", OTHER)):
        for first in range(0, len(points), 1 << 15):
            part = points[first : first + (1 << 15)]
            pieces = split("".join(f"{mark}{chr(p)}\n" for p in part))
            together = [span[0] // 3 for _, span in pieces if span[1] - span[0] == 2 and span[0] % 3 == 0]
            classes[np.array(part)[together]] = found
    return zlib.compress(classes.tobytes())


class PreTokenizer:
    """Cuts the UTF-8 bytes of many texts into the pre-tokens of the byte-level pattern."""

    def __init__(self, classes: bytes, special: Sequence[bytes] = ()):
        self._classes = np.frombuffer(zlib.decompress(classes), np.uint8)
        self._ascii = np.zeros(256, np.uint8)
        self._ascii[:128] = self._classes[:128]
        self.special = [s for s in special if s]

    def _byte_classes(self, data: np.ndarray) -> np.ndarray:
        """Every byte's class: that of its character."""
        classes = self._ascii[data]
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int32)
            first = padded[lead]
            tail = [padded[lead + i] & 0x3F for i in (1, 2, 3)]
            points = np.where(
                first < 0xE0,
                (first & 0x1F) << 6 | tail[0],
                np.where(
                    first < 0xF0,
                    (first & 0x0F) << 12 | tail[0] << 6 | tail[1],
                    (first & 0x07) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2],
                ),
            )
            known = points < len(self._classes)
            found = np.where(known, self._classes[np.where(known, points, 0)], OTHER).astype(np.uint8)
            classes[lead] = found
            for step, least in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
                wide = first >= least
                classes[lead[wide] + step] = found[wide]
        return classes

    def _specials(self, data: np.ndarray, segments: np.ndarray) -> list[tuple[int, int]]:
        """Places of special strings, leftmost first, none across two texts."""
        found: list[tuple[int, int]] = []
        raw = data.tobytes() if self.special else b""
        for text in self.special:
            at = raw.find(text)
            while at >= 0:
                end = at + len(text)
                if np.searchsorted(segments, at, "right") == np.searchsorted(segments, end - 1, "right"):
                    found.append((at, end))
                    at = raw.find(text, end)
                else:
                    at = raw.find(text, at + 1)
        found.sort()
        return [f for i, f in enumerate(found) if not i or f[0] >= found[i - 1][1]]

    def starts(self, data: np.ndarray, segments: np.ndarray) -> np.ndarray:
        """Where pre-tokens start. ``segments``: where the texts start, ascending, from 0."""
        size = len(data)
        if not size:
            return np.zeros(0, np.int64)
        specials = self._specials(data, segments)
        if specials:
            segments = np.union1d(segments, np.array(specials, np.int64).ravel())
        segments = segments[segments < size]
        classes = self._byte_classes(data)
        own = np.zeros(size + 1, bool)
        own[segments] = own[size] = True
        start = np.ones(size + 1, bool)
        np.not_equal(classes[1:], classes[:-1], out=start[1:size])
        start[segments] = True

        # a run of white space before other text leaves its last character to what follows
        after = np.flatnonzero(start[1:size] & (classes[:-1] == SPACE) & (classes[1:] != SPACE) & ~own[1:size]) + 1
        last = after - 1
        for _ in range(3):
            last = np.where(data[last] & 0xC0 == 0x80, last - 1, last)
        start[last] = True
        start[after[data[last] == 32]] = False

        # 's 't 'm 'd 're 've 'll at the start of a pre-token
        quote = np.flatnonzero((data == 39) & start[:size])
        quote = quote[quote + 1 < size]
        quote = quote[start[quote + 1] & ~own[quote + 1] & (classes[quote + 1] == LETTER)]
        if len(quote):
            one = data[quote + 1]
            has_two = (quote + 2 < size) & ~own[np.minimum(quote + 2, size)]
            two = np.where(has_two, data[np.minimum(quote + 2, size - 1)], 0)
            short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
            long = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
            start[quote[short | long] + 1] = False
            start[quote[short] + 2] = True
            start[quote[long] + 3] = True
        for at, end in specials:
            start[at + 1 : end] = False
        return np.flatnonzero(start[:size])


def stable_cuts(data: np.ndarray, limit: int) -> np.ndarray:
    """Starts of parts of one text, of about ``limit`` bytes, that no pre-token crosses.

    Between an ASCII letter and a space that another ASCII letter follows, a pre-token ends
    whatever stands around. A part without such a place is longer.
    """
    if len(data) <= limit:
        return np.zeros(1, np.int64)
    letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    safe = np.flatnonzero(letter[:-2] & (data[1:-1] == 32) & letter[2:]) + 1
    cuts, at = [0], 0
    while len(data) - at > limit:
        nth = int(np.searchsorted(safe, at + limit))
        if nth == len(safe):
            break
        at = int(safe[nth])
        cuts.append(at)
    return np.array(cuts, np.int64)


class WordMemo:
    """Ids of pre-tokens: looked up where met before, else asked of ``encode``.

    ``encode`` takes a list of byte strings and returns their ids, flat, and how many each has.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]):
        self._encode = encode
        self._clear()

    def _clear(self) -> None:
        self._row: dict[int, int] = {}
        self._ids = np.zeros(1 << 16, np.int32)
        self._used = 0
        self._first = np.zeros(1 << 14, np.int64)
        self._count = np.zeros(1 << 14, np.int64)

    def _learn(self, hashes: list[int], words: list[bytes]) -> None:
        ids, counts = self._encode(words)
        rows, used = len(self._row), self._used
        while used + len(ids) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        while rows + len(words) > len(self._count):
            self._first = np.concatenate([self._first, np.zeros_like(self._first)])
            self._count = np.concatenate([self._count, np.zeros_like(self._count)])
        self._ids[used : used + len(ids)] = ids
        self._first[rows : rows + len(words)] = used + np.cumsum(counts) - counts
        self._count[rows : rows + len(words)] = counts
        self._used = used + len(ids)
        self._row.update(zip(hashes, range(rows, rows + len(words)), strict=True))

    def rows(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The memo's row of each pre-token of ``data``."""
        if not len(starts):
            return np.zeros(0, np.int64)
        if len(self._row) > MEMO_WORDS:
            self._clear()
        ends = np.append(starts[1:], len(data))
        codes, distinct = pd.factorize(span_hashes(data, starts, ends))
        keys = distinct.tolist()
        get = self._row.get
        rows = np.array([get(key, -1) for key in keys], np.int64)
        new = np.flatnonzero(rows < 0)
        if len(new):
            place = np.empty(len(keys), np.int64)
            place[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
            raw, at = data.tobytes(), place[new]
            first = len(self._row)
            words = [raw[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
            self._learn([keys[i] for i in new.tolist()], words)
            rows[new] = first + np.arange(len(new))
        return rows[codes]

    def counts(self, rows: np.ndarray) -> np.ndarray:
        return self._count[rows]

    def ids(self, rows: np.ndarray) -> np.ndarray:
        return self._ids[ragged(self._first[rows], self._count[rows])]


def special_tokens(path: str) -> dict[bytes, int]:
    """Added tokens of the file, which stand for themselves inside a text."""
    with open(path) as file:
        return {t["content"].encode(): t["id"] for t in json.load(file)["added_tokens"]}


def library_encoder(path: str) -> Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]:
    """The tokenizers library on a list of pre-tokens, special strings as its default has them."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        ids = [e.ids for e in found]
        counts = np.array([len(i) for i in ids], np.int64)
        return np.fromiter((x for i in ids for x in i), np.int32, int(counts.sum())), counts

    return encode
