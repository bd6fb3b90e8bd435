"""One registered query per corpus operator, with production parameters, over whole tables.

The operators have general interfaces and real outputs; what a query adds is the fixed
result columns that are checked (digests, folds).  ``ORACLES`` holds DuckDB SQL where
SQL can express the result; the others are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewise.llm import (bpe, fingerprint, langid, licenses, lm, mining, perfect, pfair, simhash, tokenfile, topk,
                          toxicity, turns)
from casewise.llm.common import id_fold, shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@register
def op1_toxicity_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs.filter(id_fold("doc_id", 3) != 1), labels)
    out = toxicity.score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (id_fold("doc_id", 3) == 1).alias("held_out"), "score",
                      (F.col("score") >= 0.7).cast("int").alias("predicted"))


@register
def op2_minhash_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(documents(spark, sf_dir))


@register
def op3_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_decode(documents(spark, sf_dir), BYTE_BPE, keep=["doc_id"])
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@register
def op4_language_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.fit(docs.filter(id_fold("doc_id", 5) != 0))
    out = langid.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (id_fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


@register
def op5_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0, k=20, scale=64)


ORACLES["op5_threshold_topk"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
  where embedding is not null and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
), s as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.v::double[], c.v::double[])::bigint as score
  from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)
)
select query_id, rank::int as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 20
"""


@register
def op6_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=3, max_bits=2)


@register
def op7_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfair.mix(documents(spark, sf_dir).select("doc_id", "source"))


ORACLES["op7_pfair_mix"] = """
with recursive d as (
  select doc_id, source, coalesce(source, '(none)') as src, md5(coalesce(doc_id::varchar, '')) as h from documents
), r as (
  select *, row_number() over (partition by src order by h, doc_id nulls first) - 1 as rank from d
), s as (
  select src, ceil(count(*) / 64.0)::bigint as blocks from d group by src
), w as (
  select src, blocks, greatest(1, round(pow(blocks::double, 0.5) / sum(pow(blocks::double, 0.5)) over () * 256))::bigint as a from s
), cuts as (
  select 0::bigint as p union select blocks // a from w union select blocks // a + 1 from w
), kinds as (
  select p as p_from, lead(p) over (order by p) as p_to from cuts
), c as (
  select p_from, p_to, list(greatest(0, least(a, blocks - a * p_from))::bigint order by src) as c, list(src order by src) as names,
         sum(least(blocks, a * p_from))::bigint as base, sum(greatest(0, least(a, blocks - a * p_from)))::bigint as n
  from kinds, w where p_to is not null group by p_from, p_to having n > 0
), edf as (
  select p_from, 0::bigint as t, list_transform(c, lambda x: 0::bigint) as done, 0::bigint as k from c
  union all
  select p_from, t + 1, list_transform(done, lambda x, i: case when i = best then x + 1 else x end), best from (
    select e.p_from, e.t, e.done, list_min(list_transform(range(1, len(c.c) + 1), lambda k: case
        when e.done[k] < c.c[k] and (e.done[k] * c.n) // c.c[k] <= e.t
        then (((e.done[k] + 1) * c.n + c.c[k] - 1) // c.c[k]) * len(c.c) + k - 1 end)) % len(c.c) + 1 as best
    from edf e join c on e.p_from = c.p_from and e.t < c.n)
), slots as (
  select c.p_from, c.p_to, c.base, c.n, c.names[k] as src, t - 1 as pos,
         row_number() over (partition by c.p_from, k order by t) - 1 as j
  from edf join c on edf.p_from = c.p_from where t > 0
)
select r.doc_id, r.source, r.rank // 64 as block, base + ((r.rank // 64) // a - p_from) * n + pos as slot, r.rank % 64 as place
from r join w using (src) join slots on slots.src = r.src and j = (r.rank // 64) % a
  and (r.rank // 64) // a >= p_from and (r.rank // 64) // a < p_to
"""


@register
def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-shards")
    tokenfile.write_shards(documents(spark, sf_dir), path, WORD_BPE, end_id=1)
    out = tokenfile.read_documents(spark, path)
    return out.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                      F.crc32("ids").alias("ids_crc32"))


@register
def op9_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir), folds=5, held_out=1, deleted=2)


@register
def op10_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


@register
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.damage_and_repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


# crc32 byte by byte over its table of 256; then least costs backwards (four states), edits forwards
ORACLES["op11_conversation_repair"] = """
with recursive crc as (
  select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda a, z: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)) as tab
), raw as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(
             coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: ord(x)::bigint)),
             lambda a, b: xor(tab[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 20 as hit
  from conversations, crc
), dam as (
  select conv_id, turn, case when hit = 4 then 'user' else role end as role,
         case hit when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(range(case when hit = 3 then 2 else 1 end)) as copy from raw where hit <> 0
), num as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text), copy) as i,
         trim(text, ' \t\n\x0b\x0c\r') as bare from dam
), flt as (
  select *, left(role, 1) as ini, case when bare = '' then 'blank'
         when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
         when right(bare, 1) not in ('.', '!', '?') then 'truncated' end as fault,
         lag(left(role, 1)) over (partition by conv_id order by i) as prev from num
), cell as (
  select *, coalesce(fault not in ('blank', 'duplicate'), true) as free, case when fault = 'truncated' then 5 else 0 end as more from flt
), size as (
  select conv_id, count(*) as n from cell group by conv_id
), way as (
  select conv_id, n + 1 as i, [0, 10, 5, 0] as cost, [null, 1, 1, null]::int[] as step from size
  union all
  select conv_id, i, cost, list_transform(range(1, 5), lambda q: list_position([b[q][1], 5 + cost[nxt[q]], b[q][3], b[q][4]], cost[q])::int - 1) from (
    select conv_id, i, b, nxt, [least(l[1], 5 + two), least(l[2], 5 + two), two, three] as cost from (
      select *, least(l[3], 5 + l[4]) as two, least(l[4], 5 + l[3]) as three from (
        select *, list_transform(b, lambda w: least(w[1], w[3], w[4])) as l from (
          select w.conv_id, c.i, [3, 3, 4, 3] as nxt, list_transform(range(1, 5), lambda q: [2 + w.cost[q], 0,
            case when free and q = 1 and ini = 's' then more + w.cost[2] when free and q in (1, 2, 4) and ini = 'u' then more + w.cost[3]
                 when free and q = 3 and ini = 'a' then more + w.cost[4] else 1000000000 end,
            case when free then 1 + more + w.cost[[3, 3, 4, 3][q]] else 1000000000 end]) as b
          from way w join cell c on c.conv_id is not distinct from w.conv_id and c.i = w.i - 1))))
), walk as (
  select conv_id, 1::bigint as i, 1 as q, 0 as t, null::varchar as edit, null::varchar as line, 0::bigint as price from size
  union all
  select conv_id, case when x = 1 then i else i + 1 end, case when x = 0 then q when x = 2 and ini = 's' then 2 else [3, 3, 4, 3][q] end, t + 1,
         ['D', 'I', 'K', 'R'][x + 1], case x when 1 then name || ':' when 2 then role || ':' || text when 3 then name || ':' || text end,
         case x when 0 then 2 when 1 then 5 when 2 then more else 1 + more end from (
    select k.conv_id, k.i, k.q, k.t, y.step[k.q] as x, c.ini, c.role, c.text, c.more, case when k.q = 3 then 'assistant' else 'user' end as name
    from walk k join way y on y.conv_id is not distinct from k.conv_id and y.i = k.i
    left join cell c on c.conv_id is not distinct from k.conv_id and c.i = k.i) where x is not null
), fixed as (
  select conv_id, sum(price)::bigint as cost, string_agg(edit, '' order by t) as audit,
         sha256(coalesce(string_agg(line, chr(10) order by t), '')) as repaired_sha256 from walk where t > 0 group by conv_id
), tally as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
         count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
         count(*) filter (prev || ini not in ('su', 'ua', 'au')) as illegal from cell group by conv_id
)
select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
       coalesce(illegal, 0) as illegal, coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit, coalesce(repaired_sha256, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join tally t on t.conv_id is not distinct from o.conv_id left join fixed f on f.conv_id is not distinct from o.conv_id
"""


@register
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mining.hard_negatives(vectors, F.col("id") % 100 == 0, label)


ORACLES["op12_hard_negatives"] = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where label is not null and embedding is not null and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
), s as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_dot_product(a.v, c.v)::bigint as score
  from v a join v c on a.vec_id % 100 = 0 and a.vec_id <> c.vec_id and len(a.v) = len(c.v)
), p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id,
       (row_number() over (partition by anchor_id, positive_id order by score desc, vec_id))::int as rank,
       vec_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) <= 10
"""


@register
def op13_perfect_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # half of the documents stand for those of earlier runs
    out = perfect.dedup(documents(spark, sf_dir), history=id_fold("doc_id", 2) == 0)
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op13_perfect_hash_dedup"] = """
with d as (
  select doc_id, length(coalesce(text, '')) as n, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g')) as text_sha256
  from documents
), g as (
  select text_sha256, count(*) as group_size, first(doc_id order by n desc, doc_id) as keep_id from d group by all
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from d join g using (text_sha256)
"""
