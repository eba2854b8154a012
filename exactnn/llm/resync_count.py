"""Token counts of texts of any length: encode overlapping chunks, splice where they agree.

A chunk of a huge document begins and ends anywhere, so its first and last tokens may differ from
those of the whole. Two neighbours overlap; they are spliced at a place where both have a token
boundary and which is proven to be one in the whole text: after an ASCII letter, before a space
that an ASCII letter follows, the byte-level pattern ends a pre-token whatever stands around.
An overlap without such a place is widened, and at last the two chunks are taken as one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from exactnn.llm.arrow import id_and_text, slices, text_buffer
from exactnn.llm.pretoken import character_classes
from exactnn.llm.speculative_bpe import Codec, codec

#: A document of more bytes is huge; it is encoded in chunks of this size.
CHUNK_BYTES = 64 << 10
OVERLAP_BYTES = 1 << 10


class _Chunk:
    """The pre-tokens of data[begin:end], with offsets in the whole, and the tokens before each."""

    def __init__(self, tool: Codec, data: np.ndarray, begin: int, end: int):
        self.begin, self.end = begin, end
        part = data[begin:end]
        starts = tool.split.starts(part, np.zeros(1, np.int64))
        counts = tool.memo.counts(tool.memo.rows(part, starts))
        self.starts = starts + begin
        self.before = np.concatenate([[0], np.cumsum(counts)])

    def tokens(self, first: int, last: int) -> int:
        """Tokens from ``first``, one of the starts, to ``last``, another one or the end."""
        a, b = np.searchsorted(self.starts, [first, last])
        return int(self.before[b] - self.before[a])


def _character_start(data: np.ndarray, at: int) -> int:
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def _splice(data: np.ndarray, left: _Chunk, right: _Chunk) -> int | None:
    """The first boundary of both chunks at which any text is cut."""
    ours = left.starts[np.searchsorted(left.starts, right.begin + 1) :]
    ours = ours[ours < left.end - 1]
    common = ours[np.isin(ours, right.starts)]
    around = [data[common + i] for i in (-1, 0, 1)]
    before, after = (((b | 32) >= 97) & ((b | 32) <= 122) for b in (around[0], around[2]))
    stable = np.flatnonzero(before & (around[1] == 32) & after)
    return int(common[stable[0]]) if len(stable) else None


def count_huge(tool: Codec, data: np.ndarray, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES) -> int:
    """Tokens of one text in memory of the order of a chunk, where splices exist."""
    left = _Chunk(tool, data, 0, _character_start(data, min(chunk, len(data))))
    total = at = 0
    while left.end < len(data):
        width = overlap
        while True:
            begin = _character_start(data, max(left.begin, left.end - width))
            if begin <= left.begin:  # no splice in the whole chunk
                size = 2 * (left.end - left.begin)
                left = _Chunk(tool, data, left.begin, _character_start(data, min(len(data), left.begin + size)))
                break
            end = _character_start(data, min(len(data), max(begin + chunk, left.end + chunk // 2)))
            right = _Chunk(tool, data, begin, end)
            cut = _splice(data, left, right)
            if cut is not None and cut > at:
                total += left.tokens(at, cut)
                left, at = right, cut
                break
            width *= 2
    return total + left.tokens(at, left.end)


def count_tokens(
    docs: DataFrame,
    path: str,
    limit: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK_BYTES,
    overlap: int = OVERLAP_BYTES,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs``.

    Counts equal those of the tokenizers library without added special tokens, truncation or
    padding. Null and empty texts have 0 bytes and 0 tokens. Rows with equal or null ids are
    counted one by one, as are repeated rows. Texts of more than ``chunk`` bytes are counted by
    overlapping chunks. Other columns are not looked at, whatever their names; an empty table gives
    an empty one.
    """
    classes = character_classes(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, classes)
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            sizes = np.diff(offsets)
            tokens = np.zeros(len(sizes), np.int64)
            huge = np.flatnonzero(sizes > chunk)
            for row in huge.tolist():
                tokens[row] = count_huge(tool, data[offsets[row] : offsets[row + 1]], chunk, overlap)
            runs = np.concatenate([[-1], huge, [len(sizes)]])
            for lo, hi in zip((runs[:-1] + 1).tolist(), runs[1:].tolist(), strict=True):
                for first, last in slices(offsets[lo : hi + 1]):
                    texts = offsets[lo + first : lo + last + 1] - offsets[lo + first]
                    part = data[offsets[lo + first] : offsets[lo + last]]
                    starts = tool.split.starts(part, texts[:-1])
                    counts = tool.memo.counts(tool.memo.rows(part, starts))
                    before = np.concatenate([[0], np.cumsum(counts)])
                    tokens[lo + first : lo + last] = np.diff(before[np.searchsorted(starts, texts)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
