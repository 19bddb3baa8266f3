"""Queries of this subpackage, each over its whole table, and the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm import byte_bpe, line_dedup, lm_scoring, minhash_dedup, mixing, quality_rules, substring_dedup, token_counts, topk_search, warc
from strandloom.llm.common import table


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), 85)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scored(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages")).drop("url")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_decode(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.without_repeats(table(spark, sf_dir, "documents"))


OP5 = """
with p as (select page_id, coalesce(html, '') as h from pages),
m as (select h, min(page_id) as f from p where strlen(h) >= 100 group by h)
select p.page_id, strlen(p.h)::bigint as payload_bytes, sha256(p.h) as payload_digest,
  case when f < p.page_id then 'revisit' else 'response' end as record_type, case when f < p.page_id then f end as refers_to
from p left join m on p.h = m.h
"""
OP9 = """
with v as (select row_number() over () as n, vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.n, q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::bigint as score
  from v q join v c on q.vec_id % 100 = 0 and q.n <> c.n),
r as (select *, row_number() over (partition by n order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 10
"""


OP1 = r"""
with recursive base as (select row_number() over () as r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
words as (select r, doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from base),
grams as (select distinct r, doc_id, array_to_string(w[i:i + 4], ' ') as g from (select r, doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from words where len(w) > 0)),
sizes as (select r, doc_id, count(*) as n from grams group by all),
shared as (select a.r as x, b.r as y, count(*) as k from grams a join grams b on a.g = b.g and a.r <> b.r group by all),
links as materialized (select distinct p.doc_id as a, q.doc_id as b from shared join sizes p on p.r = x join sizes q on q.r = y where 100 * k >= 85 * (p.n + q.n - k)),
reach(id, c) as (select distinct doc_id, doc_id from base where doc_id is not null union select reach.id, links.b from reach join links on links.a = reach.c),
least as (select id, min(c) as c from reach group by id)
select base.doc_id, coalesce(sizes.n, 0)::bigint as n_shingles, least.c as component_id, coalesce(base.doc_id = least.c, true) as kept
from base left join sizes on sizes.r = base.r left join least on least.id = base.doc_id
"""
OP10 = r"""
with base as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (select r, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as g from (select r, doc_id, w, unnest(range(1, len(w) - 48)) as i from base where len(w) >= 50 and doc_id is not null)),
firsts as (select g, min(doc_id) as f from windows group by g),
gone as (select distinct r, i + o as p from windows join firsts using (g), (select unnest(range(0, 50)) as o) where f < doc_id),
kept as (select base.r, p, w[p] as x from (select r, w, unnest(range(1, len(w) + 1)) as p from base) base left join gone using (r, p) where gone.r is null),
joined as (select r, string_agg(x, ' ' order by p) as t, count(*) as n from kept group by r)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256 from base left join joined using (r)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_minhash_dedup, op2_mixing, op3_lm_scoring, op4_token_counts, op5_warc, op6_quality_rules, op7_byte_bpe, op8_line_dedup, op9_topk_search, op10_substring_dedup]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op1_minhash_dedup": OP1, "op10_substring_dedup": OP10, "op2_mixing": mixing.ORACLE, "op5_warc": OP5, "op6_quality_rules": quality_rules.oracle(), "op8_line_dedup": line_dedup.ORACLE, "op9_topk_search": OP9}
