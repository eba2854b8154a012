"""Packing without padding: cut each document into pieces of power-of-two length.

A document of n tokens becomes n // limit pieces of ``limit`` tokens and one piece for each binary
digit of the rest, longest first. A piece is a sequence of its own, so that no sequence crosses
documents and none needs padding; batches are formed within the buckets of equal length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from exactnn.llm.arrow import id_and_text, ragged, slices, text_buffer
from exactnn.llm.pretoken import character_classes
from exactnn.llm.speculative_bpe import codec
from exactnn.session import materialize

SEQUENCE_TOKENS = 2048
END_TOKEN = 1
#: Rows (of 20 bytes; one for each task and length) up to which a table is broadcast.
BROADCAST_ROWS = 1_000_000
#: Text of one step: ids take four bytes a token, and a task holds a few such arrays.
_STEP_BYTES = 1 << 20


def binary_pieces(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of the pieces of documents of the given lengths.

    ``limit`` is a power of two.
    """
    if limit & (limit - 1) or limit < 1:
        raise ValueError("the sequence length has to be a power of two")
    top = limit.bit_length() - 1
    bits = (lengths[:, None] >> np.arange(top - 1, -1, -1)) & 1
    number = np.concatenate([(lengths >> top)[:, None], bits], axis=1).ravel()
    sizes = np.tile(1 << np.arange(top, -1, -1, dtype=np.int64), len(lengths))
    document = np.repeat(np.arange(len(lengths)), number.reshape(len(lengths), top + 1).sum(axis=1))
    length = np.repeat(sizes, number)
    end = np.cumsum(length)
    base = np.cumsum(lengths) - lengths
    return document, end - length - base[document], length


def decompose(
    docs: DataFrame,
    path: str,
    limit: int = SEQUENCE_TOKENS,
    end_token: int = END_TOKEN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, part, nth, ids.

    ``ids`` are little-endian unsigned 32-bit integers; ``doc_tokens`` counts the end token.
    ``nth`` numbers the pieces of one length within the task ``part``. A null or empty text is a
    document of the end token alone. Rows with equal or null ids are separate documents.
    """
    classes = character_classes(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tool = codec(path, classes)
        part = TaskContext.get().partitionId()
        made = np.zeros(limit.bit_length(), np.int64)
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            names = batch.column("doc_id")
            for first, last in slices(offsets, _STEP_BYTES):
                texts = offsets[first : last + 1] - offsets[first]
                ids, bounds = tool.encode(data[offsets[first] : offsets[last]], texts)
                ids = np.insert(ids, bounds[1:], end_token).astype("<u4")
                tokens = np.diff(bounds) + 1
                document, start, length = binary_pieces(tokens, limit)
                bucket = np.log2(length).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                count = np.bincount(bucket, minlength=len(made))
                nth = np.empty(len(bucket), np.int64)
                nth[order] = ragged(made, count)
                made += count
                places = np.concatenate([[0], np.cumsum(length)]).astype(np.int64) * 4
                for a in range(0, len(length), 4096):
                    b = min(a + 4096, len(length))
                    raw = pa.py_buffer(ids[places[a] // 4 : places[b] // 4].tobytes())
                    ends = pa.py_buffer((places[a : b + 1] - places[a]).astype(np.int32).tobytes())
                    yield pa.RecordBatch.from_arrays(
                        [
                            names.take(pa.array(first + document[a:b])),
                            pa.array(start[a:b]),
                            pa.array(length[a:b]),
                            pa.array(tokens[document[a:b]]),
                            pa.array(np.full(b - a, part, np.int32)),
                            pa.array(nth[a:b]),
                            pa.Array.from_buffers(pa.binary(), b - a, [None, ends, raw]),
                        ],
                        ["doc_id", "start", "length", "doc_tokens", "part", "nth", "ids"],
                    )

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, start long, length long, doc_tokens long, part int, nth long, ids binary"
    )


def number_sequences(pieces: DataFrame, limit: int = SEQUENCE_TOKENS) -> DataFrame:
    """``pieces`` (a stored table) with ``sequence_id`` and ``offset`` for ``part`` and ``nth``.

    The n-th sequence of the bucket of length 2**b has the id n * (buckets) + b: numbers are dense
    within a bucket and never meet between buckets. Only one row per task and bucket is ordered.
    """
    buckets = limit.bit_length()
    bucket = F.log2("length").cast("long")
    sizes = pieces.groupBy("part", "length").agg(F.count("*").alias("pieces"))
    sizes = materialize(sizes, "sizes")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("part", "length", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("first"))
    if sizes.count() <= BROADCAST_ROWS:  # then the pieces, with their ids, need not be shuffled
        firsts = F.broadcast(firsts)
    return pieces.join(firsts, ["part", "length"]).select(
        *[c for c in pieces.columns if c not in ("part", "nth")],
        ((F.col("first") + F.col("nth")) * buckets + bucket).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def pack(
    docs: DataFrame,
    path: str,
    limit: int = SEQUENCE_TOKENS,
    end_token: int = END_TOKEN,
    keep_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids_crc32, sequence_id, offset.

    With ``keep_ids`` also ``ids``. The pieces are stored once in the shared folder, so that their
    numbers are fixed whatever is run again. A null text is an empty one, which is the end token
    alone. Repeated rows, and rows with null or equal ids, are documents of their own; other columns
    are not looked at, whatever their names. An empty table gives an empty one.
    """
    pieces = decompose(docs, path, limit, end_token, id_col, text_col)
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids"))
    if not keep_ids:
        pieces = pieces.drop("ids")
    return number_sequences(materialize(pieces, "pieces"), limit)


def equal_batches(packed: DataFrame, batch_tokens: int, limit: int = SEQUENCE_TOKENS) -> DataFrame:
    """``packed`` with ``batch``: sequences of one length, ``batch_tokens`` tokens together."""
    nth = F.floor(F.col("sequence_id") / limit.bit_length())
    group = F.floor(nth * F.col("length") / batch_tokens)
    return packed.withColumn("batch", group * limit.bit_length() + F.log2("length").cast("long"))
