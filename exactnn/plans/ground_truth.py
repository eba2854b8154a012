"""End-to-end jobs: sentence and token ground truths.

Each stage writes its table and the next one reads it, so a job that was stopped goes on from
the last finished table, and no embedding or distance is computed twice. Beside each output
stands a stamp of the parameters and tables it was made from, written last: an output without it,
or with another one, is made anew.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exactnn.functions.models import PACKED_DIMENSIONS, TOKEN_MODEL
from exactnn.operators import corpus as C
from exactnn.operators import quality as Q
from exactnn.operators.embed import embed_text, embedder_for
from exactnn.operators.knn import knn_join
from exactnn.sources.bundle import check_positions, export
from exactnn.sources.naming import Naming
from exactnn.sources.tables import is_stamped, set_stamp, stamp_of, write_vectors


@dataclass(frozen=True)
class Corpus:
    """A text table: its text column, its unique non-null order key, and its title if any."""

    table: DataFrame
    text: str
    order: Sequence[str]
    title: str | None = None


@dataclass(frozen=True)
class GroundTruth:
    query: DataFrame
    base: DataFrame
    neighbours: DataFrame
    manifest: DataFrame
    names: Naming
    checks: DataFrame | None = None


def _stored(spark: SparkSession, make, path: str, stamp: str) -> DataFrame:
    """The table at ``path``, made first where it is not a finished one of this ``stamp``."""
    if not is_stamped(spark, path, stamp):
        write_vectors(make(), path, mode="overwrite")
        set_stamp(spark, path, stamp)
    return spark.read.parquet(path)


def _long(counters: DataFrame) -> DataFrame:
    """One row of counters -> (check, value) rows."""
    return counters.unpivot([], counters.columns, "check", "value")


def sentence_ground_truth(
    spark: SparkSession,
    query: Corpus,
    base: Corpus,
    root: str,
    model: str,
    query_count: int,
    base_count: int,
    k: int = 100,
    *,
    output_dimension: int | None = None,
    output_dtype: str | None = None,
    metric: str = "sqeuclidean",
    bundle: bool = True,
    validate: bool = False,
    single_file: bool = False,
    knn_options: dict | None = None,
) -> GroundTruth:
    """Embed both corpora by sentence, find the k nearest base vectors of every query, export.

    The query side is the first ``query_count`` non-zero sentence vectors; the base side the
    first ``base_count``, those with a title of the query side first.
    """
    factory, dim = embedder_for(model, output_dimension, output_dtype or "float")
    check_positions(base_count)
    names = Naming(root, model, dim, query_count, base_count, k, output_dtype, metric)
    packed = PACKED_DIMENSIONS.get(model, 1) if output_dtype in ("binary", "ubinary") else 1

    def embedder(role: str):
        def run(df: DataFrame, text: str) -> DataFrame:
            return embed_text(df, text, factory, dim, model=model, role=role, packed=packed)

        return run

    queries = _stored(
        spark,
        lambda: C.query_vectors(
            query.table, embedder("query"), query_count, query.text, query.order, query.title
        ),
        names.query_table,
        query_stamp := _made_from(query, model=model, dim=dim, n=query_count, dtype=output_dtype),
    )

    def make_base() -> DataFrame:
        titles = None
        if query.title and base.title:
            titles = C.distinct_titles(queries, query.title)
        return C.base_vectors(
            base.table, titles, embedder("document"), base_count, base.text, base.order,
            base.title or "title",
        )

    base_stamp = _made_from(
        base, model=model, dim=dim, n=base_count, dtype=output_dtype,
        titles=query_stamp if query.title and base.title else None,
    )
    bases = _stored(spark, make_base, names.base_table, base_stamp)
    return _finish(
        spark, queries, bases, names, metric, bundle, validate, single_file, knn_options or {},
        [query_stamp, base_stamp],
    )


def _made_from(corpus: Corpus, **parameters) -> str:
    return stamp_of(
        table=corpus.table, text=corpus.text, order=list(corpus.order), title=corpus.title,
        **parameters,
    )


def token_ground_truth(
    spark: SparkSession,
    query: Corpus,
    base: Corpus,
    root: str,
    token_factory,
    dim: int,
    query_tokens: int,
    base_tokens: int,
    k: int = 100,
    *,
    model: str = TOKEN_MODEL,
    metric: str = "inner",
    bundle: bool = True,
    validate: bool = False,
    single_file: bool = False,
    knn_options: dict | None = None,
) -> GroundTruth:
    """The same for one vector per token; titles play no part."""
    check_positions(base_tokens)
    names = Naming(root, model, dim, query_tokens, base_tokens, k, metric=metric)
    stamps = [
        _made_from(side, model=model, dim=dim, n=n, tokens=True)
        for side, n in ((query, query_tokens), (base, base_tokens))
    ]
    queries = _stored(
        spark, lambda: token_vectors(query, token_factory, dim, query_tokens, "query_id"),
        names.query_table, stamps[0],
    )
    bases = _stored(
        spark, lambda: token_vectors(base, token_factory, dim, base_tokens, "base_id"),
        names.base_table, stamps[1],
    )
    return _finish(
        spark, queries, bases, names, metric, bundle, validate, single_file, knn_options or {},
        stamps,
    )


def token_vectors(
    corpus: Corpus, token_factory, dim: int, n: int | None, id_name: str
) -> DataFrame:
    """First ``n`` token vectors of a corpus, numbered from 0 by (order, token_idx)."""
    return C.token_vectors(
        corpus.table, corpus.text, corpus.order, token_factory, dim, n, id_name
    )


def _finish(
    spark, queries, bases, names: Naming, metric, bundle, validate, single_file, knn_options, stamps
) -> GroundTruth:
    base_rows = bases.count()
    result = _stored(
        spark,
        lambda: knn_join(queries, bases, names.k, metric, **knn_options),
        names.result_table,
        stamp := stamp_of(
            sides=stamps, k=names.k, metric=metric, decimals=knn_options.get("decimals"),
        ),
    )
    manifest = export(
        spark, names, result, queries, bases, base_rows, bundle=bundle, single_file=single_file,
        stamp=stamp_of(result=stamp, single_file=single_file),
    )
    checks = None
    if validate:
        expected = min(names.k, base_rows)
        order = Q.monotone_check(result).select(F.col("violations").alias("order_violations"))
        checks = (
            _long(Q.validate(result, queries, bases, metric))
            .unionByName(_long(Q.completeness(result, queries, expected)))
            .unionByName(_long(order))
        )
    return GroundTruth(queries, bases, result, manifest, names, checks)
