"""Embedding a text column with a user-supplied model.

A model enters as a factory, called once per task, that returns ``embed(texts, input_type)`` ->
one vector per text. It is registered under the catalogue's model names with
:func:`register_embedder`. Two deterministic embedders are built in, so that jobs run offline.
"""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exactnn.functions import vectors as V
from exactnn.functions.models import MODEL_DIMENSIONS, check_dtype, effective_dimension
from exactnn.functions.text import model_input, sentences

MAX_CHUNK = 64

# Role of a corpus -> input type that models with such a parameter expect.
INPUT_TYPES = {"query": "search_query", "document": "search_document", None: None}

Embed = Callable[[Sequence[str], str | None], Sequence]
Factory = Callable[[], Embed]

_log = logging.getLogger(__name__)
_registry: dict[str, Callable[[int, str], Factory]] = {}


def register_embedder(model: str, build: Callable[[int, str], Factory]) -> None:
    """``build(dim, dtype)`` returns the factory that tasks call for ``model``."""
    _registry[model] = build


def embedder_for(model: str, dim: int | None = None, dtype: str = "float") -> tuple[Factory, int]:
    """Factory and effective dimension for a model name."""
    if model in MODEL_DIMENSIONS:
        check_dtype(model, dtype)
        dim = effective_dimension(model, dim)
    if model not in _registry:
        raise KeyError(f"no embedder registered for {model!r}; see register_embedder")
    if dim is None:
        raise ValueError(f"{model!r} is not in the catalogue, so it needs a dimension")
    return _registry[model](dim, dtype), dim


def embed_text(
    df: DataFrame,
    text: str,
    factory: Factory,
    dim: int,
    *,
    model: str = "",
    role: str | None = None,
    chunk: int = MAX_CHUNK,
    output: str = "embedding",
    packed: int = 1,
    flag: str | None = None,
    bisect: bool = False,
) -> DataFrame:
    """Add one vector per text. A chunk whose call fails gets zero vectors (dropped later).

    With ``bisect`` such a chunk is halved and called again, until only the texts that fail by
    themselves are without a vector.

    Only a failing call is passed over: a model that returns another number of vectors, or
    vectors of another width, ends the job. ``flag`` names a boolean column that is false for
    texts whose call failed; :func:`exactnn.operators.corpus.ingest_stats` counts them.
    """
    if not 0 < chunk <= MAX_CHUNK:
        raise ValueError(f"chunk must be between 1 and {MAX_CHUNK}")
    if role not in INPUT_TYPES:
        raise ValueError("role must be 'query', 'document' or None")
    width = dim // packed
    function = _chunked(factory, width, chunk, INPUT_TYPES[role], flag is not None, bisect)
    if flag is None:
        return df.withColumn(output, _once(function)(model_input(text, model)))
    run = _once(function, "struct<vector array<float>, embedded boolean>")
    made = df.withColumn("_made", run(model_input(text, model)))
    return made.withColumns(
        {output: F.col("_made.vector"), flag: F.col("_made.embedded")}
    ).drop("_made")


def _once(function, kind: str = "array<float>"):
    """Not deterministic for the optimizer, which would else copy the call into every filter
    on its result and run the model twice."""
    return F.arrow_udf(function, kind).asNondeterministic()


def _chunked(factory: Factory, width: int, chunk: int, input_type: str | None, flagged: bool, bisect: bool = False):
    def embed_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        embed = factory()
        for batch in batches:
            texts = batch.to_pylist()
            out = np.zeros((len(texts), width), dtype=np.float32)
            done = np.ones(len(texts), dtype=bool)
            calls = [(at, min(at + chunk, len(texts))) for at in range(0, len(texts), chunk)][::-1]
            while calls:
                at, end = calls.pop()
                part = texts[at:end]
                try:
                    vectors = embed(part, input_type)
                except Exception as problem:  # a failed call must not end the job
                    if bisect and len(part) > 1:
                        half = (at + end) // 2
                        calls += [(half, end), (at, half)]
                    else:
                        done[at:end], last = False, problem
                    continue
                vectors = np.asarray(vectors, dtype=np.float32)
                if vectors.shape != (len(part), width):
                    raise ValueError(
                        f"the model returned {vectors.shape} for {len(part)} texts of width {width}"
                    )
                out[at:at + len(part)] = vectors
            if not done.all():
                _log.warning("no embeddings for %d texts, the last: %s", (~done).sum(), last)
            lists = _lists(out.ravel(), np.arange(len(texts) + 1) * width)
            yield pa.StructArray.from_arrays([lists, pa.array(done)], ["vector", "embedded"]) if flagged else lists

    return embed_batches


def _lists(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.float32()))


def embed_tokens(
    df: DataFrame,
    text: str,
    factory: Callable[[], Callable[[Sequence[str]], np.ndarray]],
    output: str = "tokens_flat",
) -> DataFrame:
    """One flat array per row: the token vectors of all of its sentences, one after another.

    ``factory`` returns a function from a row's sentences to a (tokens, dim) matrix. A null text
    has no sentences and no tokens.
    """

    def embed_rows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        embed = factory()
        for batch in batches:
            rows = [np.asarray(embed(r), dtype=np.float32).ravel() for r in (b or [] for b in batch.to_pylist())]
            offsets = np.cumsum([0, *map(len, rows)])
            yield _lists(np.concatenate([np.zeros(0, np.float32), *rows]), offsets)

    return df.withColumn(output, _once(embed_rows)(sentences(text)))


def token_rows(
    flat: DataFrame, order: Sequence[str], dim: int, column: str = "tokens_flat"
) -> DataFrame:
    """One row per token vector: the order columns, ``token_idx`` and ``embedding``.

    The zero test is made on a row's whole array, as one text is one embedding here.
    """
    kept = flat.where(~V.is_zero(column))
    slices = V.token_slices(column, dim)
    return kept.select(*order, F.posexplode(slices).alias("token_idx", "embedding"))


# --- built-in embedders ------------------------------------------------------------------


def _digest(token: str) -> bytes:
    return hashlib.md5(token.encode()).digest()


def hashing_embedder(dim: int, dtype: str = "float") -> Factory:
    """Feature hashing: each blank-separated token adds +1 or -1 to one component.

    With h the first four bytes of the token's md5 as a big-endian number, the component is
    ``(h // 2) % dim`` and the sign is + for even h. Vectors are scaled to unit length; a text
    whose tokens cancel out stays zero.
    """

    def factory() -> Embed:
        known: dict[str, tuple[int, float]] = {}

        def place(token: str) -> tuple[int, float]:
            if token not in known:
                if len(known) > 1_000_000:
                    known.clear()
                h = int.from_bytes(_digest(token)[:4], "big")
                known[token] = (h // 2 % dim, 1.0 - 2.0 * (h % 2))
            return known[token]

        def embed(texts: Sequence[str], input_type: str | None = None) -> np.ndarray:
            rows, cols, signs = [], [], []
            for row, text in enumerate(texts):
                for token in text.split(" "):
                    if token:
                        col, sign = place(token)
                        rows.append(row), cols.append(col), signs.append(sign)
            cells = np.asarray(rows, dtype=np.int64) * dim + np.asarray(cols, dtype=np.int64)
            sums = np.bincount(cells, weights=signs, minlength=len(texts) * dim)
            sums = sums.reshape(len(texts), dim)
            length = np.sqrt(np.einsum("ij,ij->i", sums, sums))[:, None]
            return np.divide(sums, length, out=np.zeros_like(sums), where=length > 0)

        return embed

    return factory


def hashing_token_embedder(dim: int = 16) -> Callable[[], Callable[[Sequence[str]], np.ndarray]]:
    """One vector per token: the first ``dim`` bytes of its md5, less 128, at unit length.

    Beyond 16 bytes the digests of the token with a NUL and 1, 2, ... after it follow.
    """
    if dim < 1:
        raise ValueError("a vector needs a component")

    def digests(token: str) -> bytes:
        more = (_digest(f"{token}\0{i}") for i in range(1, -(-dim // 16)))
        return b"".join([_digest(token), *more])[:dim]

    def factory():
        known: dict[str, np.ndarray] = {}

        def vector(token: str) -> np.ndarray:
            if token not in known:
                if len(known) > 1_000_000:
                    known.clear()
                raw = np.frombuffer(digests(token), np.uint8).astype(np.float64) - 128.0
                known[token] = (raw / np.sqrt((raw * raw).sum() or 1.0)).astype(np.float32)
            return known[token]

        def embed(texts: Sequence[str]) -> np.ndarray:
            found = [vector(token) for text in texts for token in text.split(" ") if token]
            return np.stack(found) if found else np.zeros((0, dim), np.float32)

        return embed

    return factory


HASHING_MODEL = "hashing"
register_embedder(HASHING_MODEL, hashing_embedder)


