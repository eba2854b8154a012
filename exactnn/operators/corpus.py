"""From text tables to vector tables: title matching, first-N sentences, dropped zeros."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exactnn.functions import vectors as V
from exactnn.functions.text import explode_sentences, normalise_title, sentences
from exactnn.operators.embed import embed_tokens, token_rows
from exactnn.operators.ids import dense_index, first_n, position_boundary, up_to
from exactnn.operators.joins import BROADCAST_BYTES, key_bytes, keyed_filter, null_safe_key, split_join
from exactnn.session import materialize

Embedder = Callable[[DataFrame, str], DataFrame]


def distinct_titles(query: DataFrame, title: str = "title") -> DataFrame:
    """Distinct titles of the query side, with ``_`` read as a space."""
    return query.select(normalise_title(title).alias("title")).distinct()


def _title_keys(titles: DataFrame) -> DataFrame:
    keys = titles.select(null_safe_key("title").alias("_key")).distinct()
    return materialize(keys, "title_keys")


def title_filter(
    base: DataFrame, titles: DataFrame, spread_on: str, title: str = "title", matching: bool = True
) -> DataFrame:
    """Base rows whose title is (or is not) among ``titles``; null only matches null."""
    keyed = base.withColumn("_key", null_safe_key(title))
    how = "left_semi" if matching else "left_anti"
    return keyed_filter(keyed, _title_keys(titles), "_key", spread_on, how).select(*base.columns)


def with_match_flag(
    base: DataFrame, titles: DataFrame, spread_on: str, title: str = "title", flag: str = "matched",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add whether the title is among ``titles``: both passes of the fill in one join."""
    keys = _title_keys(titles)
    keyed = base.withColumn("_key", null_safe_key(title))
    hits = keys.withColumn(flag, F.lit(True))
    if key_bytes(keys, "_key") <= broadcast_bytes:
        joined = keyed.join(F.broadcast(hits), "_key", "left")
    else:
        joined = split_join(keyed, hits, "_key", spread_on, "left")
    return joined.select(*base.columns, F.coalesce(flag, F.lit(False)).alias(flag))


def priority_fill(
    base: DataFrame, titles: DataFrame, order: Sequence[str], n: int, title: str = "title"
) -> DataFrame:
    """First ``n`` rows: those with a matching title first, then the others, each in ``order``."""
    ranked = with_match_flag(base, titles, order[-1], title)
    ranked = ranked.withColumn("_later", (~F.col("matched")).cast("int"))
    return first_n(ranked, ["_later", *order], n).drop("_later")


def first_nonzero(
    df: DataFrame, order: Sequence[str], n: int, vector: str = "embedding"
) -> DataFrame:
    """First ``n`` rows under ``order`` that are not zero vectors."""
    return first_n(df.where(~V.is_zero(vector)), order, n)


def first_stretches(
    corpus: DataFrame,
    order: Sequence[str],
    counts: DataFrame,
    n: int,
    make: Callable[[DataFrame], DataFrame],
    target: int,
) -> DataFrame:
    """Results of ``make`` for as many corpus rows, in ``order``, as yield ``n`` of them.

    ``make`` is the expensive step and stores its result, so rows behind the n-th are not put
    through it. ``counts`` (order columns, ``_count``) estimates the yield per corpus row: the
    row at which the running count reaches ``target`` ends the first stretch, which is a filter
    on the scan. If that yields too little, the next stretch is sized by the yield so far; as
    stretches grow geometrically, there are few of them.
    """
    counts = materialize(counts, "counts")
    kept, found, spent, after = None, 0, 0, None
    while True:
        ahead, rows = counts, corpus
        if after is not None:
            ahead, rows = counts.where(~up_to(order, after)), corpus.where(~up_to(order, after))
        stop = position_boundary(ahead, order, target, "_count")
        part = make(rows if stop is None else rows.where(up_to(order, stop)))
        kept = part if kept is None else kept.unionByName(part)
        found, spent, after = found + part.count(), spent + target, stop
        if found >= n or stop is None:
            return kept
        estimate = math.ceil(1.1 * (n - found) * spent / found) if found else 2 * spent
        target = max(estimate, spent // 8, 1)


def sentence_vectors(
    corpus: DataFrame,
    text: str,
    order: Sequence[str],
    embedder: Embedder,
    n: int | None = None,
    id_name: str = "vec_id",
    title: str | None = None,
) -> DataFrame:
    """One row per non-zero sentence embedding, the first ``n`` under ``order`` + ``sent_idx``.

    The corpus columns are carried along, the text being the sentence and the title normalised.
    ``id_name`` numbers the rows from 0. ``order`` has to be a unique, non-null key. Without
    ``n`` every sentence is used.
    """
    if title is not None:
        corpus = corpus.withColumn(title, normalise_title(title))

    def embedded(rows: DataFrame) -> DataFrame:
        vectors = embedder(explode_sentences(rows, text), text).where(~V.is_zero("embedding"))
        return materialize(vectors, "sentence_vectors")

    if n is None:
        kept = embedded(corpus)
    else:
        counts = corpus.select(*order, F.size(sentences(text)).alias("_count"))
        kept = first_stretches(corpus, order, counts, n, embedded, target=n)
    indexed = dense_index(kept, [*order, "sent_idx"], id_name)
    return indexed if n is None else indexed.where(F.col(id_name) < n)


def token_vectors(
    corpus: DataFrame,
    text: str,
    order: Sequence[str],
    token_factory: Callable[[], Callable[[Sequence[str]], np.ndarray]],
    dim: int,
    n: int | None = None,
    id_name: str = "vec_id",
) -> DataFrame:
    """One row per token vector, the first ``n`` under ``order`` + ``token_idx``, numbered from 0."""

    def embedded(rows: DataFrame) -> DataFrame:
        flat = embed_tokens(rows.select(*order, text), text, token_factory)
        return materialize(token_rows(flat, order, dim), "token_vectors")

    if n is None:
        kept = embedded(corpus)
    else:
        counts = corpus.select(*order, F.size(sentences(text)).alias("_count"))
        # a sentence has several tokens; how many is known after the first stretch
        kept = first_stretches(corpus, order, counts, n, embedded, target=max(1, n // 16))
    indexed = dense_index(kept, [*order, "token_idx"], id_name)
    return indexed if n is None else indexed.where(F.col(id_name) < n)


def query_vectors(
    corpus: DataFrame,
    embedder: Embedder,
    n: int | None = None,
    text: str = "question",
    order: Sequence[str] = ("row_id",),
    title: str | None = "title",
) -> DataFrame:
    """Query side of a ground truth: ``query_id``, the corpus columns, ``embedding``."""
    return sentence_vectors(corpus, text, order, embedder, n, "query_id", title)


def base_vectors(
    corpus: DataFrame,
    titles: DataFrame | None,
    embedder: Embedder,
    n: int | None = None,
    text: str = "text",
    order: Sequence[str] = ("row_id",),
    title: str = "title",
) -> DataFrame:
    """Base side: rows with a title of the query side come first. Adds ``base_id``."""
    if titles is None:
        return sentence_vectors(corpus, text, order, embedder, n, "base_id")
    flagged = with_match_flag(corpus, titles, order[-1], title)
    ranked = flagged.withColumn("_later", (~F.col("matched")).cast("int"))
    ranked = ranked.withColumn(title, normalise_title(title))
    vectors = sentence_vectors(ranked, text, ["_later", *order], embedder, n, "base_id")
    return vectors.drop("_later")


def ingest_stats(
    corpus: DataFrame, vectors: DataFrame, text: str, vector: str = "embedding",
    expected: int | None = None,
) -> DataFrame:
    """Rows, sentences, vectors kept, zero vectors skipped, texts whose model call failed, and
    vectors asked for, in one row.

    ``vectors`` are the embedded sentences before the zero filter; failed ones, which are zero
    vectors as well, are those whose column ``embedded`` is false, if there is one.
    """
    embedded = F.col("embedded") if "embedded" in vectors.columns else F.lit(True)
    none = F.lit(0).cast("long")
    zero = V.is_zero(vector)
    read = corpus.agg(
        F.count("*").alias("source_rows"),
        F.coalesce(F.sum(F.size(sentences(text))), none).alias("sentences"),
        none.alias("kept"),
        none.alias("skipped_zero"),
        none.alias("failed"),
    )
    made = vectors.agg(
        none.alias("source_rows"),
        none.alias("sentences"),
        F.count(F.when(~zero, 1)).alias("kept"),
        F.count(F.when(zero, 1)).alias("skipped_zero"),
        F.count(F.when(~embedded, 1)).alias("failed"),
    )
    names = ("source_rows", "sentences", "kept", "skipped_zero", "failed")
    totals = [F.sum(c).alias(c) for c in names]
    return read.unionByName(made).agg(*totals).withColumn(
        "expected", F.lit(expected).cast("long") if expected is not None else F.col("sentences")
    )
