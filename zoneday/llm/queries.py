"""The operators as queries over whole tables, with SQL restatements where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from zoneday.llm import (
    byte_cnn,
    certified_packing,
    crf_language,
    extendible_index,
    ftrl_toxicity,
    laesa_codes,
    merge_rounds,
    nn_descent,
    ownership,
    polar_whitening,
    prefix_containment,
    run_index,
    trie_join,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return keep


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@query("op1_crf_language")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf_language.language(documents(spark, sf_dir))


@query("op2_ftrl_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ftrl_toxicity.toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


@query(
    "op3_run_index",
    """
    with b as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
    blocks as (select doc_id, k, h[2 * k + 1 : 2 * k + 1422] as h from b, unnest(range(0, len(h) // 2 - 199, 512)) as u(k)),
    starts as (select doc_id, k + i as pos, md5(h[2 * i + 1 : 2 * i + 400]) as bytes
        from blocks, unnest(range(0, least(512, len(h) // 2 - 199))) as u(i)),
    again as (select doc_id, pos from starts join (select bytes from starts group by 1 having count(*) > 1) using (bytes)),
    marked as (select doc_id, pos, coalesce(pos > lag(pos) over (partition by doc_id order by pos) + 200, true) as fresh from again),
    runs as (select doc_id, run, min(pos) as head, max(pos) + 200 as tail
        from (select doc_id, pos, count_if(fresh) over (partition by doc_id order by pos) as run from marked) group by 1, 2),
    cuts as (select doc_id, run, head, tail, coalesce(lag(tail) over (partition by doc_id order by run), 0) as prev from runs),
    kept as (select doc_id, sum(tail - head) as n_removed, count(*) as n_spans,
        string_agg(h[2 * prev + 1 : 2 * head], '' order by run) || any_value(h)[2 * max(tail) + 1 :] as rest
        from cuts join b using (doc_id) group by 1)
    select doc_id, cast(len(h) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
      coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(rest, h))) as kept_sha256
    from b left join kept using (doc_id)
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_index.remove_repeats(documents(spark, sf_dir))


@query("op4_byte_cnn")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_cnn.quality(documents(spark, sf_dir), labels(spark, sf_dir))


@query("op5_merge_rounds")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_rounds.encode_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query(
    "op6_extendible_index",
    """
    select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
      doc_id = max(doc_id) over w as kept, sha256(coalesce(text, '')) as text_sha256
    from documents window w as (partition by coalesce(text, ''))
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extendible_index.exact_duplicates(documents(spark, sf_dir))


# Letters of either case are written out: what "ignore case" takes in beyond A-Z differs between engines.
_ASSIGN = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name) for name in ("password", "passwd", "secret", "token", "api_?key")
)
_ASSIGN = rf"""({_ASSIGN})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_ONE_CHARACTER = "|".join(f"{chr(c)}{{6}}" for c in range(0x2D, 0x7B) if chr(c).isalnum() or chr(c) in "_-")


def _matches(kind: str, pattern: str, wanted: str) -> str:
    """SQL: where the pattern's leftmost matches lie, from the lengths of the pieces between them."""
    return f"""
    {kind}_found as (select doc_id, source, place, hit, sum(len(gap) + len(hit)) over (partition by doc_id order by place) as past
        from (select doc_id, source, unnest(hits) as hit, unnest(gaps[: len(hits)]) as gap, unnest(range(len(hits))) as place
            from (select doc_id, source, regexp_extract_all(t, '{pattern}') as hits, string_split_regex(t, '{pattern}') as gaps from d))),
    {kind}_spans as (select doc_id, source, hit, cast(past - len(hit) as bigint) as start, cast(past as bigint) as past from {kind}_found where {wanted})"""


@query(
    "op7_ownership",
    f"""
    with d as (select doc_id, coalesce(source, '') as source, coalesce(text, '') as t from documents),
    {_matches("assign", _ASSIGN, f"len(regexp_extract(hit, '{_ASSIGN}', 2)) >= 12")},
    {_matches("access", "AKIA[A-Z0-9]+", "len(hit) >= 18")},
    {_matches("hex", "[0-9a-f]+", "len(hit) >= 16")},
    {_matches("token", "[A-Za-z0-9_-]+", "len(hit) >= 20")},
    base as (
        select *, 0 as rank, 'assign' as kind, regexp_extract(hit, '{_ASSIGN}', 2) as value from assign_spans
        union all select *, 1, 'access', hit from access_spans
        union all select *, 2, 'hex', hit from hex_spans),
    live as (select *, 3 as rank, 'owned' as kind, hit as value from token_spans
        where regexp_matches(hit, '[A-Za-z]') and regexp_matches(hit, '[0-9][^0-9]*[0-9]') and not regexp_matches(hit, '{_ONE_CHARACTER}')),
    candidate as (select * from base union all select * from live),
    held as (select value, count(distinct split_part(source, '/', 1)) <= 2 and count(distinct source) <= 16 as own from candidate group by 1),
    judged as (select * from candidate join held using (value)),
    spans as (select * from judged where rank < 3 or own),
    counted as (select doc_id,
        count_if(rank = 0) as n_assign, count_if(rank = 1) as n_access, count_if(rank = 2) as n_hex, count_if(rank = 3 and own) as n_owned,
        count_if(rank = 3 and not own) as n_copied, count_if(rank < 3 and own) as n_base_own, count_if(rank < 3 and not own) as n_base_copied
        from judged group by 1),
    listed as (select doc_id, string_agg(kind || ':' || start || ':' || past, ',' order by start, rank, past) as spans,
        string_agg(kind || ':' || start || ':' || past, ',' order by start, rank, past) filter (where rank < 3) as base
        from spans group by 1)
    select doc_id, sha256(coalesce(base, '')) as base_sha256, coalesce(listed.spans, '') as spans,
      {", ".join(f"cast(coalesce({c}, 0) as bigint) as {c}" for c in ("n_assign", "n_access", "n_hex", "n_owned", "n_copied", "n_base_own", "n_base_copied"))}
    from d left join counted using (doc_id) left join listed using (doc_id)
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ownership.secrets(documents(spark, sf_dir))


@query("op8_certified_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return certified_packing.best_fit_sequences(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("byte_bpe_50k.json")
    )


@query(
    "op9_trie_join",
    r"""
    with recursive d as (select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
    s as (select distinct doc_id, array_to_string(w[i : i + 4], ' ') as shingle
        from d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as u(i) where len(w) > 0),
    sizes as (select doc_id, count(*) as n from s group by 1),
    shared as (select a.doc_id as a, b.doc_id as b, count(*) as n_shared from s a join s b using (shingle) where a.doc_id <> b.doc_id group by 1, 2),
    links as (select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * n_shared >= 75 * (x.n + y.n - n_shared)),
    reach(doc_id, other) as (select a, b from links union select r.doc_id, l.b from reach r join links l on l.a = r.other),
    lowest as (select doc_id, min(other) as other from reach group by 1)
    select doc_id, coalesce(n, 0) as n_shingles, least(doc_id, coalesce(other, doc_id)) as component_id
    from d left join sizes using (doc_id) left join lowest using (doc_id)
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_join.near_duplicates(documents(spark, sf_dir))


@query(
    "op10_nn_descent",
    """
    with recursive v as (select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
        where label is not null and embedding is not null
          and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links as (select a.vec_id as a, b.vec_id as b from v a join v b using (label)
        where a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.93),
    reach(vec_id, other) as (select a, b from links union select r.vec_id, l.b from reach r join links l on l.a = r.other),
    lowest as (select vec_id, min(other) as other from reach group by 1),
    linked as (select a as vec_id, count(*) as n from links group by 1)
    select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(other, vec_id)) as component_id,
      vec_id = least(vec_id, coalesce(other, vec_id)) as kept
    from embeddings left join linked using (vec_id) left join lowest using (vec_id)
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(embeddings(spark, sf_dir))


@query("op11_polar_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polar_whitening.whiten(embeddings(spark, sf_dir))


def _books(n: int, before: str) -> str:
    """SQL: the nearest entry of every part, and the codebooks after one round."""
    return f"""
    a{n} as (select vec_id, p, min({{'d': d, 'e': e}}) as m from (
        select vec_id, x.p, e, list_sum(list_transform(list_zip(x.z, b.z), lambda v: (v[1] - v[2]) * (v[1] - v[2]))) as d
        from parts x join {before} b using (p)) group by 1, 2),
    m{n} as (select p, e, list(v order by pos) as z from (
        select p, m.e as e, pos, cast(floor(cast(sum(z[pos]) as double) / count(*)) as bigint) as v
        from a{n} join parts using (vec_id, p), unnest(range(1, width + 1)) as u(pos) group by 1, 2, 3) group by 1, 2),
    b{n + 1} as (select p, e, coalesce(m{n}.z, {before}.z) as z from {before} left join m{n} using (p, e))"""


@query(
    "op12_laesa_codes",
    f"""
    with kept as (select vec_id, label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as z from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
    parts as (select vec_id, label, p, len(z) // 16 as width, z[p * (len(z) // 16) + 1 : (p + 1) * (len(z) // 16)] as z
        from kept, unnest(range(0, 16)) as u(p)),
    b0 as (select p, e, z from parts join (select vec_id, row_number() over (order by vec_id) - 1 as e from kept) using (vec_id) where e < 64),
    {_books(0, "b0")}, {_books(1, "b1")}, {_books(2, "b2")},
    coded as (select vec_id, string_agg(printf('%02x', m.e), '' order by p) as code, cast(sum(m.d) as bigint) as error from a2 group by 1),
    digest as (select sha256(string_agg(cast(z[pos] as varchar), ',' order by p, e, pos)) as codebooks_sha256
        from b2, unnest(range(1, len(z) + 1)) as u(pos))
    select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
    from coded join kept using (vec_id), digest
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return laesa_codes.codes(embeddings(spark, sf_dir))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op13_prefix_containment",
    f"""
    with d as (select doc_id, {_WORDS} as w from documents),
    b as (select cast(item_id as varchar) as item, {_WORDS} as w from benchmark),
    wins as (select distinct item, least(len(w), 10) as m, array_to_string(w[i : i + 9], ' ') as t
        from b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as u(i) where len(w) > 0),
    places as (select doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') as t
        from d, (select distinct m from wins), unnest(range(1, len(w) - m + 2)) as u(i)),
    hits as (select distinct doc_id, m, i, item from places join wins using (m, t)),
    inside as (select doc_id, count(distinct pos) as n_hit from (select doc_id, unnest(range(i, i + m)) as pos from hits) group by 1),
    listed as (select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from hits group by 1)
    select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
      sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from d left join inside using (doc_id) left join listed using (doc_id)
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_containment.decontamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
