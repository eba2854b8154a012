"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, learned filters of eight bytes slide over the whole text in steps of four,
and each of the overlapping chunks keeps the maximum of every filter. A document is what its
chunks have at most, on average and at least; a small hidden layer makes one probability of it.
The least says how varied the poorest chunk is: copies of one line excite few filters.

The network is fitted on the driver, on a bounded sample of labelled rows, and applied to whole
texts in the tasks. Convolution and pooling go through a text in steps, so that memory does not
depend on its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exactnn.llm.arrow import id_and_text, slices, text_buffer

STRIDE, EMBEDDING, FILTERS, HIDDEN = 4, 8, 32, 16
#: A block is what chunks are made of: a chunk is CHUNK_BLOCKS blocks, the next begins HOP_BLOCKS on.
BLOCK_BYTES, CHUNK_BLOCKS, HOP_BLOCKS = 128, 4, 3
PAD = 256
_POSITIONS = BLOCK_BYTES // STRIDE
#: Blocks convolved in one step.
_STEP_BLOCKS = 1024
#: Bounds of the labelled sample that the network is fitted on.
SAMPLE_ROWS, SAMPLE_TEXT_BYTES = 6000, 32 << 10
#: The threshold on the score from which a document is predicted good.
THRESHOLD = 0.7


@dataclass
class Network:
    """``embed`` (257, E), ``filters`` (2, stride * E, F), hidden and output layers."""

    embed: np.ndarray
    filters: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def start(rng: np.random.Generator) -> Network:
        normal = lambda *shape: rng.normal(size=shape).astype(np.float32)
        embed = normal(257, EMBEDDING)
        embed[PAD] = 0
        width = STRIDE * EMBEDDING
        return Network(
            embed, normal(2, width, FILTERS) / np.float32(np.sqrt(2 * width)),
            normal(3 * FILTERS, HIDDEN) / np.float32(np.sqrt(3 * FILTERS)), np.zeros(HIDDEN, np.float32),
            normal(HIDDEN) / np.float32(np.sqrt(HIDDEN)), np.zeros(1, np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.hidden, self.hidden_bias, self.out, self.out_bias]


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with at least ``STRIDE`` padding each, in whole blocks; block bounds of each."""
    sizes = np.diff(offsets)
    blocks = -(-(sizes + STRIDE) // BLOCK_BYTES)
    bounds = np.concatenate([[0], np.cumsum(blocks)])
    out = np.full(int(bounds[-1]) * BLOCK_BYTES, PAD, np.int16)
    for a, b, at in zip(offsets[:-1].tolist(), offsets[1:].tolist(), (bounds[:-1] * BLOCK_BYTES).tolist(), strict=True):
        out[at : at + b - a] = data[a:b]
    return out, bounds


def convolve(net: Network, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Filter values (positions, F) of whole blocks. ``ends``: last positions of texts, which see padding only."""
    rows = net.embed[symbols].reshape(-1, STRIDE * EMBEDDING)
    out = rows @ net.filters[0]
    out[:-1] += rows[1:] @ net.filters[1]
    out[ends] = 0
    return out


def block_maxima(net: Network, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Maximum of each filter in each block, in steps; a step sees the first group of the next."""
    total = int(bounds[-1])
    ends = bounds[1:] * _POSITIONS - 1
    maxima = np.empty((total, FILTERS), np.float32)
    for a in range(0, total, _STEP_BLOCKS):
        b = min(a + _STEP_BLOCKS, total)
        part = symbols[a * BLOCK_BYTES : b * BLOCK_BYTES + STRIDE]
        if b == total:
            part = np.concatenate([part, np.full(STRIDE, PAD, np.int16)])
        inside = ends[(ends >= a * _POSITIONS) & (ends < b * _POSITIONS)] - a * _POSITIONS
        values = convolve(net, part, inside)[:-1]
        maxima[a:b] = values.reshape(b - a, _POSITIONS, FILTERS).max(axis=1)
    return np.maximum(maxima, 0)


def chunks_of(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last + 1 block of all chunks, and the chunk bounds of each text."""
    sizes = np.diff(bounds)
    number = 1 + np.maximum(0, -(-(sizes - CHUNK_BLOCKS) // HOP_BLOCKS))
    first = np.concatenate([[0], np.cumsum(number)])
    nth = np.arange(first[-1]) - np.repeat(first[:-1], number)
    begin = np.repeat(bounds[:-1], number) + nth * HOP_BLOCKS
    return begin, np.minimum(begin + CHUNK_BLOCKS, np.repeat(bounds[1:], number)), first


def pool(maxima: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunk maxima, the chunk bounds of texts, and each text's features (most, mean, least)."""
    begin, end, first = chunks_of(bounds)
    chunk = maxima[begin].copy()
    for step in range(1, CHUNK_BLOCKS):
        np.maximum(chunk, maxima[np.minimum(begin + step, end - 1)], out=chunk)
    starts = first[:-1]
    count = np.diff(first)[:, None].astype(np.float32)
    mean = np.add.reduceat(chunk, starts, axis=0) / count
    most = np.maximum.reduceat(chunk, starts, axis=0)
    least = np.minimum.reduceat(chunk, starts, axis=0)
    return chunk, first, np.concatenate([most, mean, least], axis=1)


def _probability(net: Network, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(features @ net.hidden + net.hidden_bias)
    return hidden, 1 / (1 + np.exp(-np.clip(hidden @ net.out + net.out_bias, -30, 30)))


def predict(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    symbols, bounds = padded(data, offsets)
    features = pool(block_maxima(net, symbols, bounds), bounds)[2]
    return _probability(net, features)[1].astype(np.float64)


def _gradients(net: Network, symbols: np.ndarray, bounds: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
    """Of the mean log loss of a batch."""
    symbols = np.concatenate([symbols, np.full(STRIDE, PAD, np.int16)])
    values = convolve(net, symbols, bounds[1:] * _POSITIONS - 1)[:-1]
    blocks = values.reshape(-1, _POSITIONS, FILTERS)
    where = blocks.argmax(axis=1)
    maxima = np.maximum(np.take_along_axis(blocks, where[:, None], axis=1)[:, 0], 0)
    chunk, first, features = pool(maxima, bounds)
    hidden, p = _probability(net, features)
    d_logit = ((p - label) / len(label)).astype(np.float32)
    d_hidden = d_logit[:, None] * net.out * (1 - hidden**2)
    d_features = d_hidden @ net.hidden.T
    # features to chunks
    number = np.diff(first)
    owner = np.repeat(np.arange(len(label)), number)
    d_most, d_mean, d_least = np.split(d_features, 3, axis=1)
    d_chunk = d_mean[owner] / number[owner][:, None]
    for d, pooled in ((d_most, features[:, :FILTERS]), (d_least, features[:, 2 * FILTERS :])):
        same = chunk == pooled[owner]
        d_chunk += np.where(same, d[owner], 0) / np.maximum(np.add.reduceat(same, first[:-1], axis=0), 1)[owner]
    # chunks to blocks to positions
    begin, end, _ = chunks_of(bounds)
    members = np.minimum(begin[:, None] + np.arange(CHUNK_BLOCKS), (end - 1)[:, None])
    block = np.take_along_axis(members[:, :, None], maxima[members].argmax(axis=1)[:, None], axis=1)[:, 0]
    column = np.broadcast_to(np.arange(FILTERS), block.shape)
    live = (chunk > 0) & (d_chunk != 0)
    block, column, d = block[live], column[live], d_chunk[live]
    position = block * _POSITIONS + where[block, column]
    d_embed = np.zeros_like(net.embed)
    d_filters = np.zeros_like(net.filters)
    rows = net.embed[symbols].reshape(-1, STRIDE * EMBEDDING)
    groups = symbols.reshape(-1, STRIDE)
    order = np.argsort(column, kind="stable")
    block, column, d, position = block[order], column[order], d[order], position[order]
    heads = np.searchsorted(column, np.arange(FILTERS + 1))
    for half in (0, 1):
        seen = rows[position + half] * d[:, None]
        for f in range(FILTERS):
            d_filters[half, :, f] = seen[heads[f] : heads[f + 1]].sum(axis=0)
        back = (net.filters[half].T[column] * d[:, None]).reshape(-1, STRIDE, EMBEDDING)
        for i in range(STRIDE):
            symbol = groups[position + half, i]
            for e in range(EMBEDDING):
                d_embed[:, e] += np.bincount(symbol, back[:, i, e], minlength=257).astype(np.float32)
    d_embed[PAD] = 0
    return [
        d_embed, d_filters, features.T @ d_hidden, d_hidden.sum(axis=0), hidden.T @ d_logit, d_logit.sum(keepdims=True)
    ]


def fit(
    texts: list[bytes], labels: list[int], epochs: int = 8, least_steps: int = 600, batch: int = 32,
    rate: float = 4e-3, seed: int = 17,
) -> Network:
    """Adam on log loss, for ``epochs`` or as many more as make ``least_steps`` steps.

    With one class only, the network says that class.
    """
    rng = np.random.default_rng(seed)
    net = Network.start(rng)
    label = np.array(labels, np.float32)
    share = (label.sum() + 1) / (len(label) + 2) if len(label) else 0.5
    net.out_bias[:] = np.log(share / (1 - share))
    if len(set(labels)) < 2:
        net.out[:] = 0
        return net
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    per_epoch = -(-len(texts) // batch)
    epochs = max(epochs, -(-least_steps // per_epoch))
    step, steps = 0, epochs * per_epoch
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), batch):
            own = order[a : a + batch]
            part = [texts[i] for i in own]
            offsets = np.cumsum([0, *map(len, part)])
            symbols, bounds = padded(np.frombuffer(b"".join(part), np.uint8), offsets)
            step += 1
            pace = rate * (1 - step / (steps + 1))
            for p, g, (m, v) in zip(
                net.parameters(), _gradients(net, symbols, bounds, label[own]), moments, strict=True
            ):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return net


def training_sample(
    docs: DataFrame, labels: DataFrame, rows: int, most_bytes: int, id_col: str, text_col: str, label_col: str
) -> tuple[list[bytes], list[int]]:
    """At most ``rows`` labelled texts of at most ``most_bytes`` bytes, chosen by a hash of the id.

    Rows whose crc32(doc_id) mod 4 is 2 are held out. Rows are cut down by their labels first, so
    that only chosen ids, a bounded list, meet the documents.
    """
    key = F.col(id_col).cast("long")
    allowed = F.pmod(F.crc32(F.col(id_col).cast("long").cast("string")), F.lit(4)) != 2
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & allowed)
        .groupBy(key.alias("doc_id")).agg(F.min(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    texts = id_and_text(docs, id_col, text_col).where(F.octet_length("text") <= most_bytes)
    found = texts.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "text").limit(rows).toArrow()
    return [t.encode() for t in found.column("text").to_pylist()], found.column("label").to_pylist()


def _scores(net: Network, column: pa.Array) -> np.ndarray:
    data, offsets = text_buffer(column)
    score = np.zeros(len(offsets) - 1)
    for first, last in slices(offsets, 1 << 20):
        texts = offsets[first : last + 1] - offsets[first]
        score[first:last] = predict(net, data[offsets[first] : offsets[last]], texts)
    return score


def keep_good(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_text_bytes: int = SAMPLE_TEXT_BYTES,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **training,
) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches THRESHOLD; see ``score_quality``.

    Repeated rows stay or go together; columns may have any names; an empty table stays empty.
    """
    net = fit(*training_sample(docs, labels, sample_rows, sample_text_bytes, id_col, text_col, label_col), **training)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(net, batch.column(at)) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    sample_text_bytes: int = SAMPLE_TEXT_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    **training,
) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted of every row.

    The network learns from at most ``sample_rows`` labelled texts of at most
    ``sample_text_bytes`` bytes, never from held-out rows (crc32(doc_id) mod 4 is 2); it sees
    nothing but the text. Scores are of whole texts. Null and empty texts have the score of an
    empty text; a null id is not held out; rows with equal ids are scored one by one. Without
    labels every score is 0.5, with one class only it is near that class. Repeated rows are scored
    each; other columns are not looked at, whatever their names; an empty table gives an empty one.
    """
    net = fit(*training_sample(docs, labels, sample_rows, sample_text_bytes, id_col, text_col, label_col), **training)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _scores(net, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    scored = id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    return scored.select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
