"""Checks on vector tables and on stored neighbour lists. Each returns a DataFrame of counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from exactnn.functions import vectors as V
from exactnn.functions.models import dimension_ok
from exactnn.operators.joins import keyed_filter, split_join
from exactnn.operators.knn import knn_join
from exactnn.session import materialize


def _count_if(test: Column) -> Column:
    return F.coalesce(F.sum(F.when(test, 1).otherwise(0)), F.lit(0)).cast("long")


def _known(test: Column) -> Column:
    """``test``, false where it is null."""
    return F.coalesce(test, F.lit(False))


def dimensions(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Smallest and largest dimension over all rows."""
    size = F.size(vector)
    return df.agg(
        F.count("*").alias("row_count"), F.min(size).alias("min_dim"), F.max(size).alias("max_dim")
    )


def dimension_check(
    df: DataFrame, model: str, declared: int, vector: str = "embedding"
) -> DataFrame:
    """Rows whose dimension is not the declared one, allowing for packed output.

    A null vector is a violation and counted apart as well.
    """
    ok = dimension_ok(F.lit(model), F.lit(declared), F.size(vector))
    return df.agg(
        F.count("*").alias("row_count"),
        _count_if(~_known(ok)).alias("violations"),
        _count_if(F.col(vector).isNull()).alias("null_vectors"),
    )


def norm_check(df: DataFrame, tolerance: float = 1e-6, vector: str = "embedding") -> DataFrame:
    """Rows that are not unit vectors; null vectors and those with null components are none."""
    unit = F.abs(V.norm(vector) - 1.0) < tolerance
    return df.agg(
        F.count("*").alias("row_count"),
        _count_if(~_known(unit)).alias("violations"),
        _count_if(F.col(vector).isNull()).alias("null_vectors"),
    )


def zero_check(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Kept and dropped rows of the zero-vector filter, which drops null vectors too."""
    zero, absent = V.is_zero(vector), F.col(vector).isNull()
    return df.agg(
        _count_if(~absent & ~_known(zero)).alias("kept"),
        _count_if(~absent & _known(zero)).alias("dropped"),
        _count_if(absent).alias("null_vectors"),
    )


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, non-null and null count, smallest and largest value as text.

    Of arrays, maps and binary columns the length counts as the value; structs have none.
    """
    plain = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    aggregates = [F.count("*").alias("_rows")]
    for i, field in enumerate(df.schema.fields):
        kind, value = field.dataType.typeName(), F.col(f"`{field.name}`")
        measured = {
            "array": lambda v: F.size(v), "map": lambda v: F.size(v), "binary": lambda v: F.length(v),
            "struct": lambda v: F.lit(None).cast("string"),
        }.get(kind, lambda v: v)(value)
        measured = F.when(value.isNotNull(), measured)
        aggregates += [
            F.count(value).alias(f"_n{i}"),
            F.min(measured).cast("string").alias(f"_lo{i}"),
            F.max(measured).cast("string").alias(f"_hi{i}"),
        ]
    lines = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("column_type"),
            F.col(f"_n{i}").alias("value_count"),
            (F.col("_rows") - F.col(f"_n{i}")).alias("null_count"),
            F.col(f"_lo{i}").alias("min_value"),
            F.col(f"_hi{i}").alias("max_value"),
        )
        for i, (name, kind) in enumerate(plain)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*lines)))


def feasible_k(base_rows: int, k: int) -> bool:
    """Whether the base can fill k places. A smaller base yields all of its rows."""
    return base_rows >= k


def feasibility(base: DataFrame, ks: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """(by..., k, base_rows, feasible): for each k whether the base, or each group of it, can fill k places."""
    counts = base.groupBy(*by).agg(F.count("*").alias("base_rows"))
    asked = F.explode(F.array(*[F.lit(int(k)) for k in ks])).alias("k")
    return counts.select(*by, asked, "base_rows").withColumn("feasible", F.col("base_rows") >= F.col("k"))


def completeness(result: DataFrame, query: DataFrame, k: int, query_id: str = "query_id") -> DataFrame:
    """Queries without any, with fewer than, and with exactly ``k`` neighbours."""
    found = result.groupBy("query_id").agg(F.count("*").alias("_found"))
    per_query = query.select(F.col(query_id).alias("query_id")).join(found, "query_id", "left")
    places = F.coalesce("_found", F.lit(0))
    return per_query.agg(
        F.count("*").alias("queries"),
        _count_if(places == 0).alias("missing"),
        _count_if((places > 0) & (places < k)).alias("short"),
        _count_if(places == k).alias("complete"),
        _count_if(places > k).alias("surplus"),
    )


def monotone_check(result: DataFrame) -> DataFrame:
    """Places whose distance is smaller than that of the place before."""
    by_rank = Window.partitionBy("query_id").orderBy("rank")
    before = result.withColumn("_before", F.lag("distance").over(by_rank))
    return before.agg(
        F.count("*").alias("row_count"),
        _count_if(F.col("distance") < F.col("_before")).alias("violations"),
    )


def gather(
    result: DataFrame,
    query: DataFrame,
    base: DataFrame,
    query_id: str = "query_id",
    base_id: str = "base_id",
    vector: str = "embedding",
    unknown: bool = False,
) -> DataFrame:
    """Put both vectors beside every stored neighbour: adds ``query_vec`` and ``base_vec``.

    A place whose query or base row does not exist is left out, or with ``unknown`` stays with a
    null vector and is told by ``unknown_query`` and ``unknown_base``.

    The base is filtered by the neighbour ids in its scan, so only rows that are some query's
    neighbour are shuffled. A base row that is a neighbour of very many queries is split.
    """
    wanted = materialize(result.select("base_id").distinct(), "neighbour_ids")
    how, there = ("left" if unknown else "inner"), F.lit(True)
    vectors = base.select(
        F.col(base_id).alias("base_id"), F.col(vector).alias("base_vec"), there.alias("_base")
    )
    near = keyed_filter(vectors, wanted, "base_id", "base_id")
    with_base = split_join(result, near, "base_id", "query_id", how)
    queries = query.select(
        F.col(query_id).alias("query_id"), F.col(vector).alias("query_vec"), there.alias("_query")
    )
    pairs = with_base.join(queries, "query_id", how)
    flags = [F.col(f"_{s}").isNull().alias(f"unknown_{s}") for s in ("query", "base")]
    return pairs.select(*result.columns, "query_vec", "base_vec", *(flags if unknown else ()))


def recomputed(
    result: DataFrame,
    query: DataFrame,
    base: DataFrame,
    metric: str = "sqeuclidean",
    rtol: float = 1e-5,
    atol: float = 1e-8,
    **columns,
) -> DataFrame:
    """Every stored neighbour with its recomputed distance, the similarity behind the stored
    one, whether both agree, whether the query is a zero vector, whether either row does not
    exist, and whether the list has the base row at an earlier place."""
    pairs = gather(result, query, base, unknown=True, **columns)
    exact = V.distance("query_vec", "base_vec", metric)
    return pairs.select(
        *result.columns,
        exact.alias("exact"),
        V.to_similarity("distance", metric).alias("similarity"),
        _known(V.is_close(exact, "distance", rtol, atol)).alias("agrees"),
        _known(V.is_zero("query_vec")).alias("zero_query"),
        "unknown_query", "unknown_base", _repeated().alias("repeated_base"),
    )


def _repeated() -> Column:
    same = Window.partitionBy("query_id", "base_id").orderBy("rank")
    return F.row_number().over(same) > 1


def _counters(agrees: Column, zero: Column) -> list[Column]:
    """What a validation counts: every stored place is ``checked``."""
    unknown = F.col("unknown_query") | F.col("unknown_base")
    return [
        F.count("*").alias("checked"),
        _count_if(~agrees & ~zero & ~unknown).alias("mismatches"),
        F.count_distinct(F.when(zero, F.col("query_id"))).alias("zero_queries"),
        *[_count_if(F.col(c)).alias(c) for c in ("unknown_query", "unknown_base", "repeated_base")],
    ]


def validate(
    result: DataFrame,
    query: DataFrame,
    base: DataFrame,
    metric: str = "sqeuclidean",
    rtol: float = 1e-5,
    atol: float = 1e-6,
    **columns,
) -> DataFrame:
    """Recompute every stored distance and count the mismatches; zero queries are skipped.

    Places that name a row that does not exist, and places that repeat a base row of their list,
    are counted apart. The default absolute tolerance also fits distances of 6 decimals.
    """
    checked = recomputed(result, query, base, metric, rtol, atol, **columns)
    return checked.agg(*_counters(F.col("agrees"), F.col("zero_query")))


def validate_similarity(
    result: DataFrame,
    query: DataFrame,
    base: DataFrame,
    rtol: float = 1e-5,
    atol: float = 1e-6,
    **columns,
) -> DataFrame:
    """The half-distance check for squared L2 on unit vectors: 1 - dot against distance / 2."""
    pairs = gather(result, query, base, unknown=True, **columns)
    gap = 1.0 - V.dot("query_vec", "base_vec")
    close = _known(V.is_close(gap, F.col("distance") / 2.0, rtol, atol))
    zero = _known(V.is_zero("query_vec"))
    flagged = pairs.withColumns({"repeated_base": _repeated(), "_close": close, "_zero": zero})
    return flagged.agg(*_counters(F.col("_close"), F.col("_zero")))


def recheck(
    result: DataFrame,
    query: DataFrame,
    base: DataFrame,
    k: int,
    metric: str = "cosine",
    atol: float = 1e-4,
    query_id: str = "query_id",
    base_id: str = "base_id",
    vector: str = "embedding",
    **knn_options,
) -> DataFrame:
    """Order check, recomputation, and a full new search for the queries that fail.

    One row per place of a failing query: the stored neighbour and distance beside the true
    ones. Empty when every list is right.
    """
    names = dict(query_id=query_id, base_id=base_id, vector=vector)
    by_rank = Window.partitionBy("query_id").orderBy("rank")
    checked = recomputed(result, query, base, metric, 1e-5, atol, **names)
    flagged = checked.withColumn("_before", F.lag("distance").over(by_rank))
    wrong = ~F.col("agrees") | _known(F.col("distance") < F.col("_before")) | F.col("repeated_base")
    failing = materialize(
        flagged.where(wrong & ~F.col("zero_query")).select("query_id").distinct(), "failing"
    )
    suspects = query.withColumnRenamed(query_id, "query_id")
    suspects = materialize(keyed_filter(suspects, failing, "query_id", "query_id"), "suspects")
    truth = knn_join(suspects, base, k, metric, base_id=base_id, vector=vector, **knn_options)
    stored = keyed_filter(result, failing, "query_id", "base_id").select(
        "query_id", "rank", F.col("base_id").alias("stored_id"),
        F.col("distance").alias("stored_distance"),
    )
    return truth.join(stored, ["query_id", "rank"], "full").select(
        "query_id", "rank", "stored_id", "stored_distance",
        F.col("base_id").alias("true_id"), F.col("distance").alias("true_distance"),
    )


def same_values(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` that ``b`` lacks and the reverse, counting repeats: (only_left, only_right)."""
    b = b.select(*a.columns)
    sides = a.withColumn("_side", F.lit(1)).unionByName(b.withColumn("_side", F.lit(-1)))
    surplus = sides.groupBy(*a.columns).agg(F.sum("_side").alias("_d"))
    return surplus.agg(
        F.coalesce(F.sum(F.greatest("_d", F.lit(0))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.greatest(-F.col("_d"), F.lit(0))), F.lit(0)).alias("only_right"),
    )
