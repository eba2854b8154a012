"""DuckDB twins of the registered queries. Built from a few shared fragments."""

from __future__ import annotations

DIM = 64
TOKEN_DIM = 16

VECTORS = "select vec_id, embedding::DOUBLE[] as v, label from embeddings"
ZEROED = (
    "select vec_id, case when label = 3 then list_transform(embedding, lambda x: 0.0)"
    " else embedding end::DOUBLE[] as v, label from embeddings"
)
COPIES = f"""
select * from ({VECTORS})
union all select vec_id + 100000000, v, label from ({VECTORS}) where label < 2
union all select vec_id + 200000000, v, label from ({VECTORS}) where label < 2"""

CLUSTERED = (
    "select vec_id, label, list_transform(embedding, lambda x, i: (x::DOUBLE * 0.25"
    " + case when i - 1 = label then 2.0 else 0.0 end)::FLOAT)::DOUBLE[] as v from embeddings"
)

SCALAR = f"""
select vec_id, list(greatest(0, least(255, case when high > low then floor((x - low) / ((high - low) / 255.0)) else 0 end))
       order by pos) as v
from (select vec_id, unnest(v) as x, generate_subscripts(v, 1) as pos from ({VECTORS}))
join (select pos, min(x) as low, max(x) as high
      from (select unnest(v) as x, generate_subscripts(v, 1) as pos from ({VECTORS})) group by pos) using (pos)
group by vec_id"""
INT8 = f"select vec_id, list_transform(v, lambda x: x - 128) as v from ({SCALAR})"
BITS = f"""
select vec_id, list_transform(range({DIM} // 8), lambda i: list_sum(list_transform(range(8),
       lambda j: case when v[8 * i + j + 1] > 0 then 1 << (7 - j) else 0 end))::INTEGER) as v from ({VECTORS})"""

DISTANCE = {
    "sqeuclidean": "power(list_distance(q.v, b.v), 2)",
    "cosine": "1 - list_inner_product(q.v, b.v)"
    " / sqrt(list_inner_product(q.v, q.v) * list_inner_product(b.v, b.v))",
    "inner": "1 - list_inner_product(q.v, b.v)",
}
SAFE_COSINE = (
    "case when list_inner_product(q.v, q.v) = 0 or list_inner_product(b.v, b.v) = 0 then 1.0"
    f" else {DISTANCE['cosine']} end"
)


def knn(query: str, base: str, k: int, metric: str, expression: str | None = None) -> str:
    """Top k of every (id, v) row of ``query`` among the (id, v) rows of ``base``."""
    exact = expression or DISTANCE[metric]
    return f"""
    select query_id, (place - 1)::INTEGER as rank, base_id, distance from (
      select query_id, base_id, distance,
             row_number() over (partition by query_id order by distance, base_id) as place
      from (select q.id as query_id, b.id as base_id, round({exact}, 6) + 0.0 as distance
            from ({query}) q cross join ({base}) b))
    where place <= {k}"""


def ids(source: str) -> str:
    return f"select vec_id as id, v, label from ({source})"


def self_knn(k: int, metric: str) -> str:
    return knn(ids(VECTORS), ids(VECTORS), k, metric)


def components(source: str, keys: str, vector: str = "v") -> str:
    return f"""
    select {keys}, pos::INTEGER as pos, round(value, 6) + 0.0 as value from (
      select {keys}, unnest({vector}) as value, generate_subscripts({vector}, 1) - 1 as pos
      from ({source}))"""


BLANKS = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
SPLIT = (
    "list_filter(list_transform(string_split(regexp_replace(regexp_replace(text,"
    " '([.!?。！？…])\\s+', concat('\\1', chr(1)), 'g'), '([。！？])([^.!?。！？…\\s])',"
    " concat('\\1', chr(1), '\\2'), 'g'), chr(1)), "
    f"lambda s: trim(s, {BLANKS})), lambda s: length(s) > 0)"
)


def sentences(source: str, keys: str) -> str:
    return f"""
    select {keys}, unnest(parts) as text, (generate_subscripts(parts, 1) - 1)::INTEGER as sent_idx
    from (select {keys}, {SPLIT} as parts from ({source}))"""


def hashed(source: str, keys: str) -> str:
    """Non-zero feature-hashed vectors of (keys, text) rows: adds ``v``."""
    return f"""
    select {keys}, any_value(text) as text, list(x order by pos) as v from (
      select {keys}, text, p.pos, coalesce(x, 0.0) as x from (
        select {keys}, any_value(text) as text,
               map_from_entries(list((pos, (w / n)::FLOAT::DOUBLE))) as m
        from (
          select *, sqrt(sum(w * w) over (partition by {keys})) as n from (
            select {keys}, any_value(text) as text, (h // 2) % {DIM} as pos,
                   sum(case when h % 2 = 0 then 1.0 else -1.0 end)::DOUBLE as w
            from (select {keys}, text, ('0x' || substr(md5(token), 1, 8))::BIGINT as h
                  from (select {keys}, text, unnest(string_split(text, ' ')) as token
                        from ({source})) where token <> '')
            group by {keys}, (h // 2) % {DIM}))
        where n > 0 group by {keys}) s
      cross join (select range as pos from range({DIM})) p
      left join lateral (select s.m[p.pos] as x) on true)
    group by {keys}"""


def all_hashed(source: str, keys: str) -> str:
    """As ``hashed`` but with the zero vectors kept: adds ``v``."""
    return f"""
    select s.*, coalesce(h.v, list_transform(range({DIM}), lambda i: 0.0)) as v
    from ({source}) s left join (select {keys}, v from ({hashed(source, keys)})) h using ({keys})"""


def tokens(source: str, order: str, id_name: str) -> str:
    """One md5-byte vector per token, numbered by (order, token_idx)."""
    byte = "('0x' || substr(md5(token), 2 * i + 1, 2))::INTEGER - 128.0"
    return f"""
    select row_number() over (order by {order}, token_idx) - 1 as {id_name}, {order},
           token_idx::INTEGER as token_idx,
           list_transform(raw, lambda x: (x / sqrt(list_inner_product(raw, raw)))::FLOAT::DOUBLE) as v
    from (
      select {order}, token_idx,
             list_transform(range({TOKEN_DIM}), lambda i: ({byte})::DOUBLE) as raw
      from (
        select {order}, token, row_number() over (
                 partition by {order} order by sent_idx, place) - 1 as token_idx
        from (select {order}, sent_idx, unnest(parts) as token,
                     generate_subscripts(parts, 1) as place
              from (select {order}, sent_idx, string_split(text, ' ') as parts
                    from ({sentences(source, order)})))
        where token <> ''))"""


QUERY_CORPUS = (
    "select doc_id, case when lang <> 'es' then concat(source, '_', lang) end as title, text"
    " from documents where doc_id in (select doc_id from labels where toxic = 1)"
)
BASE_CORPUS = (
    "select doc_id, case when lang <> 'es' then concat(source, ' ', lang) end as title, text"
    " from documents"
)
ALL_TITLED = BASE_CORPUS.replace("source, ' ', lang", "source, '_', lang")
TITLES = f"select distinct replace(title, '_', ' ') as title from ({QUERY_CORPUS})"
MATCHED = (
    "exists (select 1 from titles t where t.title is not distinct from d.title) as matched"
)
FLAGGED = f"with titles as ({TITLES}) select d.*, {MATCHED} from ({BASE_CORPUS}) d"


def numbered(source: str, order: str, name: str, n: int | None = None) -> str:
    limit = "" if n is None else f" where {name} < {n}"
    return f"""
    select * from (select row_number() over (order by {order}) - 1 as {name}, * from ({source}))
    {limit}"""


QUERY_SENTENCES = hashed(
    sentences(f"select doc_id, replace(title, '_', ' ') as title, text from ({QUERY_CORPUS})",
              "doc_id, title"),
    "doc_id, title, sent_idx",
)
BASE_SENTENCES = hashed(
    sentences(FLAGGED, "doc_id, title, matched"), "doc_id, title, matched, sent_idx"
)


def truth_query(n: int) -> str:
    return numbered(QUERY_SENTENCES, "doc_id, sent_idx", "query_id", n)


# all documents as queries, for what is no matter of a small query side
ALL_SENTENCES = hashed(
    sentences(f"select doc_id, replace(title, '_', ' ') as title, text from ({ALL_TITLED})",
              "doc_id, title"),
    "doc_id, title, sent_idx",
)


def truth_base(n: int, titles: str = TITLES) -> str:
    flagged = f"with titles as ({titles}) select d.*, {MATCHED} from ({BASE_CORPUS}) d"
    rows = hashed(sentences(flagged, "doc_id, title, matched"), "doc_id, title, matched, sent_idx")
    return numbered(rows, "(not matched)::INT, doc_id, sent_idx", "base_id", n)


def truth(queries: int, bases: int, metric: str) -> str:
    """The end-to-end job: titles come from the first query vectors."""
    titles = f"select distinct title from ({truth_query(queries)})"
    return knn(
        f"select query_id as id, v from ({truth_query(queries)})",
        f"select base_id as id, v from ({truth_base(bases, titles)})", 10, metric,
    )


E2E = truth(400, 10000, "sqeuclidean")
E2E_TITLES = f"select distinct title from ({truth_query(400)})"

ITEM_SENTENCES = hashed(sentences("select item_id, text from benchmark", "item_id"),
                        "item_id, sent_idx")
DOC_SENTENCES = hashed(sentences("select doc_id, text from documents", "doc_id"),
                       "doc_id, sent_idx")
TURN_SENTENCES = sentences("select conv_id, turn, text from conversations", "conv_id, turn")

ITEM_TOKENS = tokens("select item_id, text from benchmark", "item_id", "query_id")
TURN_TOKENS = tokens("select conv_id, turn, text from conversations", "conv_id, turn", "base_id")


def token_search(query_rows: int | None = None, base_rows: int | None = None) -> str:
    def cut(name: str, n: int | None) -> str:
        return "" if n is None else f" where {name} < {n}"

    return knn(
        f"select query_id as id, v from ({ITEM_TOKENS}){cut('query_id', query_rows)}",
        f"select base_id as id, v from ({TURN_TOKENS}){cut('base_id', base_rows)}",
        10, "inner",
    )


def corrupted(k: int, metric: str) -> str:
    return (
        f"select query_id, rank, base_id, case when rank = 3 then distance + 0.5 else distance end"
        f" as distance from ({self_knn(k, metric)})"
    )


def close(a: str, b: str, atol: str) -> str:
    return f"abs({a} - {b}) <= {atol} + 1e-5 * abs({b})"


def counted(test: str) -> str:
    return f"coalesce(sum(case when {test} then 1 else 0 end), 0)::BIGINT"


def validated(result: str, ok: str, zero: str = "false") -> str:
    """Counters of a validation; ``ok`` and ``zero`` speak of r(esult), q(uery) and b(ase)."""
    return f"""
    select count(*) as checked,
           {counted('not coalesce(ok, false) and not zero and not uq and not ub')} as mismatches,
           count(distinct case when zero then query_id end) as zero_queries,
           {counted('uq')} as unknown_query, {counted('ub')} as unknown_base,
           {counted('place > 1')} as repeated_base
    from (select r.query_id, {ok} as ok, coalesce({zero}, false) as zero, q.vec_id is null as uq,
                 b.vec_id is null as ub,
                 row_number() over (partition by r.query_id, r.base_id order by r.rank) as place
          from ({result}) r left join ({VECTORS}) q on q.vec_id = r.query_id
          left join ({VECTORS}) b on b.vec_id = r.base_id)"""


# The models that labels 0 to 9 stand for, with the dimension declared for each.
LABEL_MODELS = [
    ("text-embedding-ada-002", 1536), ("text-embedding-3-small", 1536),
    ("text-embedding-3-large", 3072), ("textembedding-gecko@003", 768),
    ("intfloat/e5-large-v2", 1024), ("intfloat/e5-base-v2", 768),
    ("intfloat/e5-small-v2", 384), ("voyage-3-large", 8 * DIM), ("voyage-3-lite", 512),
    ("colbertv2.0", 128),
]
_MODEL_ROWS = ", ".join(f"({i}, '{m}', {d})" for i, (m, d) in enumerate(LABEL_MODELS))

WIDE = ", ".join(f"embedding[{i + 1}]::DOUBLE as embedding_{i}" for i in range(DIM))


def profile_line(name: str, kind: str, table: str = "documents") -> str:
    value = f"len({name})" if "array" in kind else name
    return (
        f"select '{name}' as column_name, '{kind}' as column_type, count({name}) as value_count,"
        f" count(*) - count({name}) as null_count, min({value})::VARCHAR as min_value,"
        f" max({value})::VARCHAR as max_value from {table}"
    )


E2E_SIZES = f"""
select (select count(*) from ({truth_query(400)})) as q,
       (select count(*) from ({truth_base(10000, E2E_TITLES)})) as b"""
E2E_PARTS = f"""
with s as ({E2E_SIZES}), w as (select least(10, b)::INTEGER as k, q, b from s)
select 'test' as part, q as row_count, {DIM}::INTEGER as dim from w
union all select 'train', b, {DIM} from w union all select 'neighbors', q, k from w
union all select 'distances', q, k from w"""
E2E_CHECKS = f"""
with s as ({E2E_SIZES}), w as (select least(10, b) as k, q, b from s)
select 'checked' as "check", q * k as value from w
union all select 'queries', q from w union all select 'complete', q from w
union all select name, 0::BIGINT from (values ('mismatches'), ('zero_queries'), ('missing'),
  ('short'), ('surplus'), ('order_violations'), ('unknown_query'), ('unknown_base'),
  ('repeated_base')) t(name)"""

SMALL = (
    "select vec_id as id, list_transform(embedding, lambda x:"
    " (x::DOUBLE * 0.001::DOUBLE)::FLOAT::DOUBLE) as v from embeddings"
)


def unrounded(metric: str) -> str:
    """Nearest rows of scaled vectors, ranked on full distances."""
    return f"""
    select '{metric}' as metric, query_id, (place - 1)::INTEGER as rank, base_id,
           round(distance * 1e6, 4) + 0.0 as micro from (
      select *, row_number() over (partition by query_id order by distance, base_id) as place
      from (select q.id as query_id, b.id as base_id, {DISTANCE[metric]} as distance
            from ({SMALL}) q cross join ({SMALL}) b))
    where place <= 10"""


DOUBLED = (
    "select case when o_orderkey % 5 <> 0 then o_custkey end as custkey, o_orderkey, o_orderstatus"
    " from orders"
)
DOUBLED = f"{DOUBLED} union all {DOUBLED}"
IN_ORDER = "order by custkey nulls first, o_orderkey"
NULLED = "select case when vec_id % 11 <> 0 then embedding end as embedding from embeddings"

ORACLE_SQL = {
    "knn_sqeuclidean_block": self_knn(10, "sqeuclidean"),
    "knn_cosine_block": self_knn(10, "cosine"),
    "knn_inner_block": self_knn(10, "inner"),
    "knn_k100": self_knn(100, "sqeuclidean"),
    "knn_grid": self_knn(10, "sqeuclidean"),
    "knn_multi_file": self_knn(10, "cosine"),
    "knn_merge_partials": self_knn(10, "sqeuclidean"),
    "knn_array_form": f"select query_id, rank as pos, base_id, distance"
    f" from ({self_knn(10, 'sqeuclidean')})",
    "knn_zero_vectors": knn(ids(ZEROED), ids(ZEROED), 10, "cosine", SAFE_COSINE),
    "knn_copies": knn(ids(VECTORS), ids(COPIES), 10, "sqeuclidean"),
    "topk_monotone_check": f"""
    select count(*) as row_count, {counted('distance < before')} as violations from (
      select *, lag(distance) over (partition by query_id order by rank) as before
      from ({corrupted(10, 'sqeuclidean')}))""",
    "knn_complete_check": f"""
    select count(*) as queries, {counted('n = 0')} as missing,
           {counted('n > 0 and n < 10')} as short, {counted('n = 10')} as complete,
           {counted('n > 10')} as surplus
    from (select e.vec_id, count(r.query_id) as n from embeddings e
          left join (select * from ({self_knn(10, 'cosine')}) where distance <= 0.3) r
          on r.query_id = e.vec_id group by e.vec_id)""",
    "validate_v0": validated(
        corrupted(10, "sqeuclidean"),
        close("(1 - list_inner_product(q.v, b.v))", "(r.distance / 2)", "1e-6"), "q.label = 3"),
    "validate_metric": validated(
        corrupted(10, "cosine"), close("(" + DISTANCE["cosine"] + ")", "r.distance", "1e-6")),
    "validate_dangling": validated(
        "select case when rank = 2 then query_id + 1000000 else query_id end as query_id, rank,"
        " case when rank = 4 then base_id + 1000000 else base_id end as base_id, distance"
        f" from ({self_knn(10, 'cosine')})",
        close("(" + DISTANCE["cosine"] + ")", "r.distance", "1e-6")),
    "validate_repeats": validated(
        "select query_id, rank, case when rank = 5 then lag(base_id) over w else base_id end as"
        " base_id, case when rank = 5 then lag(distance) over w else distance end as distance"
        f" from ({self_knn(10, 'cosine')}) window w as (partition by query_id order by rank)",
        close("(" + DISTANCE["cosine"] + ")", "r.distance", "1e-6")),
    "knn_updated": knn(ids(VECTORS), f"select * from ({ids(VECTORS)}) where label > 0", 10, "sqeuclidean"),
    "knn_balls": " union all ".join(
        f"select *, '{m}' as metric from ({knn(ids(CLUSTERED), ids(CLUSTERED), 10, m)})" for m in DISTANCE
    ),
    "knn_small_scale": " union all ".join(unrounded(m) for m in DISTANCE),
    "knn_from_fvec": self_knn(10, "sqeuclidean"),
    "first_n_nulls_ties": f"select * from ({DOUBLED}) {IN_ORDER} limit 12001",
    "page_large": f"select * from ({DOUBLED}) {IN_ORDER} limit 2001 offset 11000",
    "paged_copy": "select conv_id, turn, ((row_number() over (order by conv_id, turn) - 1) // 100)"
    "::INTEGER as page from conversations",
    "null_vector_checks": f"""
    select 'dimension' as check_name, 'row_count' as counter, count(*) as value from ({NULLED})
    union all select 'dimension', 'violations', count(*) from ({NULLED}) where embedding is null
    union all select 'dimension', 'null_vectors', count(*) from ({NULLED}) where embedding is null
    union all select 'norm', 'row_count', count(*) from ({NULLED})
    union all select 'norm', 'violations', count(*) from ({NULLED}) where embedding is null
    union all select 'norm', 'null_vectors', count(*) from ({NULLED}) where embedding is null
    union all select 'zero', 'kept', count(*) from ({NULLED}) where embedding is not null
    union all select 'zero', 'dropped', count(*) from ({NULLED})
      where embedding is not null and list_inner_product(embedding, embedding) = 0
    union all select 'zero', 'null_vectors', count(*) from ({NULLED}) where embedding is null""",
    "embed_failures": f"""
    with t as ({TURN_SENTENCES}), h as ({hashed(TURN_SENTENCES, 'conv_id, turn, sent_idx')})
    select (select count(*) from conversations) as source_rows,
           (select count(*) from t) as sentences,
           (select count(*) from h where length(text) % 7 <> 0) as kept,
           (select count(*) from t) - (select count(*) from h where length(text) % 7 <> 0)
             as skipped_zero,
           (select count(*) from t where length(text) % 7 = 0) as failed,
           (select count(*) from t) as expected""",
    "embed_resumed": f"""
    with t as ({TURN_SENTENCES}), h as ({hashed(TURN_SENTENCES, 'conv_id, turn, sent_idx')})
    select (select count(*) from conversations) as source_rows,
           (select count(*) from t) as sentences,
           (select count(*) from h where length(text) % 7 <> 0) as kept,
           (select count(*) from t) - (select count(*) from h where length(text) % 7 <> 0)
             as skipped_zero,
           (select count(*) from t where length(text) % 7 = 0) as failed,
           (select count(*) from t) as expected""",
    "ground_truth_rerun": truth(100, 2000, "cosine"),
    "vector_profile": " union all ".join(
        profile_line(*c, "embeddings") for c in (
            ("vec_id", "bigint"), ("embedding", "array<float>"), ("label", "int"))),
    "validate_v1": f"""
    select query_id, rank, base_id as stored_id, round(distance + 0.25, 6) as stored_distance,
           base_id as true_id, distance as true_distance
    from ({self_knn(10, 'cosine')})
    where query_id in (select vec_id from embeddings where label = 5)""",
    "gather_neighbours": f"""
    select r.query_id, r.rank, r.base_id,
           round({DISTANCE['sqeuclidean']}, 6) + 0.0 as sqeuclidean,
           round({DISTANCE['cosine']}, 6) + 0.0 as cosine,
           round({DISTANCE['inner']}, 6) + 0.0 as inner
    from ({self_knn(10, 'sqeuclidean')}) r
    join ({VECTORS}) q on q.vec_id = r.query_id join ({VECTORS}) b on b.vec_id = r.base_id""",
    "point_lookup": f"select * from ({self_knn(10, 'sqeuclidean')}) where query_id = 42",
    "dense_index": "select lang, source, doc_id,"
    " row_number() over (order by lang, source, doc_id) - 1 as idx from documents",
    "page_rows": "select conv_id, turn, (row_number() over (order by conv_id, turn) - 1) // 100"
    " as page from conversations",
    "page_window": "select * from conversations order by conv_id, turn limit 150 offset 200",
    "sort_two_keys": "select conv_id, turn, role, row_number() over (order by conv_id, turn) - 1"
    " as place from conversations",
    "first_n_nonzero": "select vec_id, label from embeddings where label <> 3"
    " order by vec_id limit 250",
    "first_n_large": "select o_custkey, o_orderkey, o_orderstatus from orders"
    " order by o_custkey, o_orderkey limit 12000",
    "distinct_titles": f"select distinct replace(title, '_', ' ') as title from ({ALL_TITLED})",
    "title_semi": f"select doc_id, title from ({FLAGGED}) where matched",
    "title_anti": f"select doc_id, title from ({FLAGGED}) where not matched",
    "priority_fill": f"select doc_id, title, matched from ({FLAGGED})"
    " order by not matched, doc_id limit 900",
    "title_normalise": f"select doc_id, replace(title, '_', ' ') as title from ({ALL_TITLED})",
    "sentence_split": f"select doc_id, sent_idx, text from ({sentences(BASE_CORPUS, 'doc_id')})",
    "e5_prefix": "select item_id, concat('query:', text) as model_input from benchmark",
    "ingest_stats": f"""
    select (select count(*) from conversations) as source_rows,
           (select count(*) from ({TURN_SENTENCES})) as sentences,
           (select count(*) from ({hashed(TURN_SENTENCES, 'conv_id, turn, sent_idx')})) as kept,
           (select count(*) from ({TURN_SENTENCES})) -
           (select count(*) from ({hashed(TURN_SENTENCES, 'conv_id, turn, sent_idx')}))
             as skipped_zero, 0::BIGINT as failed,
           (select count(*) from ({TURN_SENTENCES})) as expected""",
    "hash_embed": components(
        all_hashed(TURN_SENTENCES, "conv_id, turn, sent_idx"), "conv_id, turn, sent_idx"
    ),
    "query_vectors": "select query_id, doc_id, title, sent_idx, text"
    f" from ({numbered(ALL_SENTENCES, 'doc_id, sent_idx', 'query_id', 5000)})",
    "base_vectors": "select base_id, doc_id, title, matched, sent_idx, text"
    f" from ({truth_base(15000)})",
    "text_and_vectors": components(ITEM_SENTENCES, "text"),
    "sentence_knn": knn(
        f"select query_id as id, v from ({numbered(ITEM_SENTENCES, 'item_id, sent_idx', 'query_id')})",
        f"select base_id as id, v from ({numbered(DOC_SENTENCES, 'doc_id, sent_idx', 'base_id')})",
        10, "cosine",
    ),
    "zero_filter": f"select {counted('label <> 3')} as kept, {counted('label = 3')} as dropped,"
    f" {counted('embedding is null')} as null_vectors from embeddings",
    "normalise_vectors": components(
        "select vec_id, list_transform(s, lambda x:"
        " (x / sqrt(list_inner_product(s, s)))::FLOAT::DOUBLE) as v from (select vec_id,"
        " list_transform(embedding, lambda x: (x * (label + 1))::FLOAT::DOUBLE) as s"
        " from embeddings)", "vec_id"),
    "norm_check": f"""
    select count(*) as row_count, {counted('abs(n - 1) >= 1e-6')} as violations,
           {counted('n is null')} as null_vectors
    from (select sqrt(list_inner_product(v, v)) * case when label = 4 then 1.5 else 1 end as n
          from ({VECTORS}))""",
    "dup_vectors": f"select min(vec_id) as first_id, count(*) as copies from ({COPIES})"
    " group by v having count(*) > 1",
    "dup_summary": f"""
    select sum(n)::BIGINT as total_rows, count(*)::BIGINT as unique_rows,
           {counted('n > 1')} as duplicate_rows
    from (select count(*) as n from ({COPIES}) group by v)""",
    "dedup_keep_first": f"select vec_id, label from ({COPIES})"
    " qualify row_number() over (partition by v order by vec_id) = 1",
    "dimension_range": "select count(*) as row_count, min(n)::INTEGER as min_dim, max(n)::INTEGER"
    " as max_dim from (select len(embedding) - (label = 7)::INTEGER as n from embeddings)",
    "dim_check": f"select count(*) as row_count, {counted('label = 7')} as violations,"
    f" {counted('embedding is null')} as null_vectors from embeddings",
    "model_dims": f"""
    select m.model, replace(m.model, '/', '_') as path_name, m.declared, count(*) as row_count,
           {counted("not (len(embedding) = declared or (model = 'voyage-3-large'"
                    " and declared = 8 * len(embedding)))")} as violations
    from embeddings e join (values {_MODEL_ROWS}) m(label, model, declared) using (label)
    group by all""",
    "list_to_wide": f"select vec_id, {WIDE} from embeddings",
    "split_wide_copy": f"select vec_id, {WIDE} from embeddings",
    "wide_to_list": components(VECTORS, "vec_id, label"),
    "float_columns": "select value from events",
    "cast_vectors": "select vec_id, (generate_subscripts(embedding, 1) - 1)::INTEGER as pos,"
    " trunc(unnest(embedding) * 127::FLOAT)::INTEGER as value from embeddings",
    "token_slices": components(
        f"select vec_id, i::INTEGER as token_idx, v[i * {TOKEN_DIM} + 1 : (i + 1) * {TOKEN_DIM}]"
        f" as v from ({VECTORS}), (select range as i from range({DIM // TOKEN_DIM}))",
        "vec_id, token_idx"),
    "table_profile": " union all ".join(
        profile_line(*c) for c in (
            ("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
            ("n_chars", "bigint"))),
    "token_rows": components(ITEM_TOKENS, "query_id, item_id, token_idx"),
    "token_knn": token_search(),
    "xvec_roundtrip": components("select vec_id as idx, v from (" + VECTORS + ")", "idx"),
    "xvec_single_file": components("select vec_id as idx, v from (" + VECTORS + ")", "idx"),
    "xvec_same_values": f"""
    with a as (select vec_id, v::FLOAT[] as v from ({VECTORS})),
         b as (select vec_id, embedding as v from embeddings)
    select (select count(*) from (from a except all from b)) as only_left,
           (select count(*) from (from b except all from a)) as only_right""",
    "xvec_count": f"select count(*) as row_count, {DIM}::INTEGER as dim from embeddings",
    "xvec_nth": components(
        "select vec_id as idx, v from (" + VECTORS + ") where vec_id = 123", "idx"),
    "xvec_records": components(
        "select vec_id as idx, v from (" + VECTORS + ") where vec_id between 121 and 179"
        " or vec_id in (3, 7, 8, 444, 498, 499)", "idx"),
    "block_files": self_knn(10, "sqeuclidean"),
    "block_manifest": f"""
    select block_id, kind, q.n as row_count, q.n * least(10, b.n) as places
    from (select (label % 3)::INTEGER as block_id, count(*) as n from ({VECTORS}) group by label % 3) b,
         (select count(*) as n from embeddings) q,
         (select unnest(['distances', 'indices']) as kind)""",
    "table_samples": f"""
    (select block_id, query_id, rank, base_id from (
      {" union all ".join(
          f"select {block} as block_id, query_id, rank, base_id from ("
          + knn(ids(VECTORS), f"select * from ({ids(VECTORS)}) where label % 3 = {block}", 10, "sqeuclidean") + ")"
          for block in range(3))}) order by query_id, block_id, rank limit 10) union all (
    select -1 as block_id, query_id, rank, base_id from ({self_knn(10, "sqeuclidean")})
    order by query_id, rank limit 10)""",
    "k_feasible": f"""
    select label, k, n as base_rows, n >= k as feasible
    from (select label, count(*) as n from ({VECTORS}) group by label), (select unnest([10, 50, 100]) as k)""",
    "ivec_roundtrip": "select query_id as idx, rank as pos, base_id::INTEGER as base_id"
    f" from ({self_knn(10, 'sqeuclidean')})",
    "parquet_roundtrip": components(
        f"select * from ({VECTORS}) order by vec_id limit 300", "vec_id"),
    "bundle_manifest": f"""
    select 'train' as part, (select count(*) from ({COPIES})) as row_count, {DIM}::INTEGER as dim
    union all select 'test', (select count(*) from embeddings), {DIM}
    union all select 'neighbors', (select count(*) from embeddings), 10
    union all select 'distances', (select count(*) from embeddings), 10""",
    "bundle_quantised": f"""
    with sizes(part, n) as (
      select 'train', count(*) from embeddings union all select 'test', count(*) from embeddings
      union all select 'neighbors', count(*) from embeddings union all select 'distances', count(*) from embeddings
    ), types("of", vectors, dim, encoding) as (
      values ('int8', 'tinyint', {DIM}, null), ('ubinary', 'smallint', {DIM} // 8, 'binary_uint8')
    )
    select "of", part, n as row_count,
           (case when part in ('train', 'test') then dim else 10 end)::INTEGER as dim,
           case part when 'neighbors' then 'bigint' when 'distances' then 'double' else vectors end as element,
           case when part in ('train', 'test') then "of" end as dtype,
           case when part in ('train', 'test') then encoding end as encoding
    from sizes cross join types""",
    "quantised_values": " union all ".join(
        f"select '{name}' as dtype, vec_id, (generate_subscripts(v, 1) - 1)::INTEGER as pos, unnest(v)::INTEGER as value from ({source})"
        for name, source in (
            ("int8", INT8), ("uint8", SCALAR), ("ubinary", BITS),
            ("binary", f"select vec_id, list_transform(v, lambda x: x - 128) as v from ({BITS})"),
        )),
    "knn_int8": knn(
        f"select vec_id as id, v::DOUBLE[] as v from ({INT8})", f"select vec_id as id, v::DOUBLE[] as v from ({INT8})",
        10, "sqeuclidean"),
    "knn_ubinary": knn(
        f"select vec_id as id, v from ({BITS})", f"select vec_id as id, v from ({BITS})", 10, "sqeuclidean",
        "list_sum(list_transform(list_zip(q.v, b.v), lambda p: bit_count(xor(p[1], p[2]))))::DOUBLE"),
    "bundle_duplicates": f"""
    select 'train' as part, sum(n)::BIGINT as total_rows, count(*)::BIGINT as unique_rows,
           {counted('n > 1')} as duplicate_rows
    from (select count(*) as n from ({COPIES}) group by v)
    union all
    select 'test', count(*)::BIGINT, count(distinct embedding)::BIGINT,
           (count(*) - count(*))::BIGINT from embeddings""",
    "ground_truth_e2e": E2E,
    "ground_truth_manifest": E2E_PARTS,
    "ground_truth_checks": E2E_CHECKS,
    "token_truth_e2e": token_search(1000, 20000),
}
