"""Registered queries of the numbered operators, on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrlake.llm import chat, decontam, langid, merkle, mixing, pii, quality, ranked, sharding, simhash, topk, toxicity, warc
from attrlake.llm.common import stored, table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = stored(topk.integer_vectors(table(spark, sf_dir, "embeddings")), "integer-vectors")
    return topk.top_k(vectors.where("vec_id % 20 = 0"), vectors)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse_and_render(table(spark, sf_dir, "conversations"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kept copy's document, source and copy number."""
    return mixing.mix(table(spark, sf_dir, "documents"), copy_column="copy").select("doc_id", "source", "copy")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_manifest(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.judged(table(spark, sf_dir, "documents"))


def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(ranked.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_decontamination, op2_simhash, op3_topk, op4_pii, op5_chat, op6_mixing, op7_sharding,
                                   op8_warc, op9_toxicity, op10_quality, op11_langid, op12_ranked, op13_merkle)}


#: DuckDB twins where SQL can express the operator on whole tables.
ORACLES = {
    "op1_decontamination": r"""
with words as (
  select 'd' as kind, row_number() over () as k, doc_id as id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
  union all
  select 'b', 0, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') from benchmark where item_id is not null and text is not null),
windows as (
  select distinct id as item_id, least(len(w), 13) as n, array_to_string(w[i:i + 12], ' ') as x
  from (select id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from words where kind = 'b' and len(w) > 0)),
lengths as (select distinct n from windows),
runs as (
  select k, i, n, array_to_string(w[i:i + n - 1], ' ') as x
  from (select k, w, n, unnest(range(1, len(w) - n + 2)) as i from words, lengths where kind = 'd' and len(w) >= n)),
hits as (select r.k, r.i, r.n, v.item_id from runs r join windows v on r.n = v.n and r.x = v.x),
covered as (select k, count(distinct p) as n_hit from (select k, unnest(range(i, i + n)) as p from hits) group by k),
named as (select k, count(*) as n_items, string_agg(item, ',' order by item) as items
          from (select distinct k, cast(item_id as varchar) as item from hits) group by k)
select d.id as doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * n_hit >= len(w) as contaminated
from words d left join covered using (k) left join named using (k) where kind = 'd'""",
    "op3_topk": """
with v as (
  select row_number() over () as r, cast(vec_id as bigint) as vec_id,
         list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as w
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.r, q.vec_id as query_id, c.vec_id,
         cast(list_sum(list_transform(list_zip(q.w, c.w), lambda p: coalesce(p[1] * p[2], 0))) as bigint) as score
  from v q join v c on q.r <> c.r where q.vec_id % 20 = 0),
ranks as (select *, row_number() over (partition by r order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from ranks where rank <= 20""",
    "op5_chat": """
with d as (select distinct conv_id, turn, role, text from conversations where conv_id is not null),
g as (select conv_id, list({'turn': turn, 'role': role, 'text': text} order by turn nulls first, role, text) as turns
      from d group by conv_id),
p as (select distinct turns[1:k] as head from (
        select turns, unnest(range(1, len(turns))) as k from g)
      where turns[k].turn is distinct from turns[k + 1].turn),
w as (select turns, min(conv_id) as conv_id, count(*) as n_equal from g group by turns),
m as (select w.conv_id, w.n_equal, w.turns from w anti join p on w.turns = p.head),
t as (select conv_id, n_equal, len(turns) as n_turns, unnest(turns) as x, unnest(range(len(turns))) as k from m)
select conv_id, k // 256 as chunk, cast(n_turns as bigint) as n_turns, n_equal,
       string_agg('<|im_start|>' || coalesce(x.role, '') || chr(10) || coalesce(x.text, '') || '<|im_end|>' || chr(10), '' order by k) as text
from t group by conv_id, chunk, n_turns, n_equal""",
}


def oracle_sql() -> dict[str, str]:
    return ORACLES | {"op12_ranked": ranked.ORACLE, "op13_merkle": merkle.oracle()}
