"""The registered queries of the corpus operators, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventmart.llm import (apportion, grace_dedup, html_density, lang_rank, length_buckets, secret_cost, simhash_pivots, source_audit,
                           tiled_pca, token_alignment, token_histogram, toxic_neighbors, warc_merkle)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents: 3-word shingles, at most 3 differing bits."""
    return simhash_pivots.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, bits=3).select(
        "doc_id", "fingerprint", "component_id")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of all documents."""
    return secret_cost.scan(_table(spark, sf_dir, "documents"))


def op3_token_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The length histogram of all documents in tokens, with its suffix sums."""
    return token_histogram.length_histogram(token_histogram.token_lengths(_table(spark, sf_dir, "documents")))


def op4_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of two replicas of the archive of all pages.

    The table has one copy of each page, so the damage is stated here: the second
    replica holds another first character for page ids 13 modulo 97 and lacks
    those 7 modulo 251; the first lacks those 5 modulo 389.
    """
    html, page_id = F.coalesce("html", F.lit("")), F.col("page_id")
    damaged = F.when(page_id % 97 == 13, F.concat(F.lit("#"), F.substring(html, 2, 2_000_000_000))).otherwise(html)
    stored = F.when(F.coalesce(page_id % 251 != 7, F.lit(True)), damaged)
    index = warc_merkle.archive(_table(spark, sf_dir, "pages"), stored)
    first = index.filter(F.coalesce(page_id % 389 != 5, F.lit(True))).drop("stored_sha256")
    second = index.filter(F.col("stored_sha256").isNotNull()).drop("record_sha256").withColumnRenamed("stored_sha256", "record_sha256")
    return warc_merkle.audit(first, second)


def op5_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed to 16 length buckets and batches of 65,536 padded tokens."""
    lengths = token_histogram.token_lengths(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return length_buckets.pack(lengths, length_col="n_tokens").withColumnRenamed("n_words", "n_tokens")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents; learned from those whose fold is not 0."""
    docs = _table(spark, sf_dir, "documents")
    fold = lang_rank.fold(F.col("doc_id"), 5)
    profiles = lang_rank.learn(docs.filter(fold != 0))
    return lang_rank.identify(docs.select("doc_id", "text"), profiles).select(
        "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 3, 1, 2 and 150 % of the words."""
    return apportion.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all embeddings of equal label at a cosine of 0.93."""
    return tiled_pca.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of all documents; labels are learned from rows whose fold is not 1."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = toxic_neighbors.score(docs, labels.filter(lang_rank.fold(F.col("doc_id"), 3) != 1))
    held_out = F.coalesce(lang_rank.fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted", "evidence")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents, white space aside."""
    return grace_dedup.exact_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return html_density.extract(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of both tokenizers over all documents."""
    return token_alignment.align(_table(spark, sf_dir, "documents"))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergences of all sources of all documents, terms of at least 30 documents a language."""
    return source_audit.audit(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_simhash_near_dedup, op2_secret_scan, op3_token_histogram, op4_warc_fixity, op5_length_buckets, op6_language_id,
        op7_source_mix, op8_embedding_near_dedup, op9_toxicity, op10_exact_dedup,
        op11_html_extraction, op12_tokenizer_alignment, op13_source_audit)}

ORACLES: dict[str, str] = {}

ORACLES["op4_warc_fixity"] = """
with parts as (
  select page_id, coalesce(url, '') as url, coalesce(html, '') as html,
         case when page_id % 97 = 13 then '#' || substr(coalesce(html, ''), 2) else coalesce(html, '') end as damaged
  from pages),
texts as (
  select page_id, url, page_id % 251 = 7 as lost,
         'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
           || coalesce(page_id::varchar, '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
           || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' as head,
         chr(13) || chr(10) || chr(13) || chr(10) as gap, html, damaged
  from parts),
digests as (
  select page_id, url, octet_length(encode(head || octet_length(encode(html))::varchar || gap || html || gap)) as length,
         sha256(head || octet_length(encode(html))::varchar || gap || html || gap) as record_sha256,
         case when not coalesce(lost, false)
           then sha256(head || octet_length(encode(damaged))::varchar || gap || damaged || gap) end as stored_sha256
  from texts),
records as (select *, count(*) as copies from digests group by all),
size as (select case when count(*) <= 1024 then 0 when count(*) <= 16384 then 1 when count(*) <= 262144 then 2
                     when count(*) <= 4194304 then 3 else 4 end as digits from records),
placed as (select *, 'warc-' || substr(record_sha256, 1, digits) as shard from records, size),
laid as (
  select *, coalesce(sum(length * copies) over (partition by shard order by page_id nulls last, url, record_sha256
                                                rows between unbounded preceding and 1 preceding), 0)::bigint as "offset"
  from placed),
replicas as (
  select *, case when coalesce(page_id % 389 <> 5, true) then record_sha256 end as first_sha256 from laid)
select shard, "offset", length::bigint as length, page_id,
       case when stored_sha256 is null then 'missing' when first_sha256 is null then 'extra' else 'changed' end as fault,
       first_sha256, stored_sha256 as second_sha256
from replicas where first_sha256 is distinct from stored_sha256
"""

ORACLES["op7_source_mix"] = """
with rows_ as (
  select doc_id, coalesce('=' || source, '') as skey, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
         md5('mix:' || coalesce(doc_id::varchar, '')) as place
  from documents),
sources as (
  select skey, any_value(source) as source, sum(size)::bigint as source_size from rows_ group by skey),
ranked as (select *, row_number() over (order by source nulls last) as rank from sources),
weighed as (select *, [3, 1, 2][(rank - 1) % 3 + 1] as weight, source_size * 2 as most from ranked),
summed as (
  select *, sum(most) over (order by most / weight, rank) - most as filled,
         sum(weight) over () - sum(weight) over (order by most / weight, rank) + weight as rest,
         sum(source_size) over () as total
  from weighed),
levels as (select *, (3 * total - 2 * filled)::double / (2 * rest)::double as level from summed),
levelled as (select *, max(case when level * weight <= most then level end) over () as final from levels),
targets as (
  select skey, rank, source_size, least(most::double, coalesce(final * weight, most::double)) as target,
         floor(total * 1.5 / 64 + 0.5)::bigint as seats,
         greatest(1, least(4096, ceil(source_size / 262144)))::bigint as shards
  from levelled),
s_sum as (select *, sum(target) over () as all_, count(*) filter (target > 0) over () as n from targets),
s_bounds as (
  select *, case when all_ > 0 then target / all_ else 0 end as part from s_sum),
s_open as (
  select *, greatest(ceil(part * (seats - n / 2) - 0.5) - 1, 0)::bigint as certain,
         case when target > 0 then floor(part * (seats + n / 2) + 0.5)::bigint + 2 else 0 end as possible from s_bounds),
s_asked as (
  select skey, rank, target, unnest(generate_series(certain + 1, possible)) as k from s_open),
s_won as (
  select skey, count(*) as won from (
    select *, row_number() over (order by target / (2 * k - 1) desc, rank, k) as spot from s_asked)
  where spot <= (select any_value(seats) - sum(certain) from s_open) group by skey),
quotas as (
  select s_open.skey, source_size, target, shards, (certain + coalesce(won, 0))::bigint as quota from s_open left join s_won using (skey)),
dealt as (
  select rows_.*, source_size, target, quota, ('0x' || substr(place, 1, 8))::bigint % shards as shard
  from rows_ join quotas using (skey)),
sizes as (select skey, shard, quota, sum(size)::bigint as shard_size from dealt group by all),
h_bounds as (
  select *, sum(shard_size) over (partition by skey) as all_, count(*) filter (shard_size > 0) over (partition by skey) as n from sizes),
h_open as (
  select *, greatest(ceil(case when all_ > 0 then shard_size / all_ else 0 end * (quota - n / 2) - 0.5) - 1, 0)::bigint as certain,
         case when shard_size > 0 then floor(shard_size / all_ * (quota + n / 2) + 0.5)::bigint + 2 else 0 end as possible from h_bounds),
h_left as (select *, quota - sum(certain) over (partition by skey) as open from h_open),
h_asked as (select skey, shard, shard_size, open, unnest(generate_series(certain + 1, possible)) as k from h_left),
h_won as (
  select skey, shard, count(*) as won from (
    select *, row_number() over (partition by skey order by shard_size / (2 * k - 1) desc, shard, k) as spot from h_asked)
  where spot <= open group by skey, shard),
blocks as (
  select skey, shard, shard_size, least((certain + coalesce(won, 0)) * 64, shard_size * 2)::bigint as words
  from h_open left join h_won using (skey, shard)),
placed as (
  select dealt.*, shard_size, words, case when shard_size > 0 then words // shard_size else 0 end as rounds,
         coalesce(sum(size) over (partition by skey, shard order by place, doc_id nulls first, size
                                  rows between unbounded preceding and 1 preceding), 0) as ahead
  from dealt join blocks using (skey, shard))
select doc_id, size, source_size, target,
       (rounds * size + least(greatest(words - rounds * shard_size - ahead, 0), size))::bigint as taken
from placed
"""

ORACLES["op8_embedding_near_dedup"] = """
with recursive usable as (
  select row_number() over () as r, vec_id, label, embedding::double[] as v,
         label is not null and embedding is not null and len(embedding) > 0
           and coalesce(list_bool_and([coalesce(isfinite(c), false) for c in embedding]), false)
           and coalesce(list_bool_or([c <> 0 for c in embedding]), false) as ok
  from embeddings),
links as (
  select a.r as a, b.r as b from usable a join usable b on a.label = b.label and a.r <> b.r and len(a.v) = len(b.v)
  where a.ok and b.ok and list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.93),
reach(r, s) as (select r, r from usable union select reach.r, links.b from reach join links on links.a = reach.s),
smallest as (select reach.r, min(u.vec_id) as component_id from reach join usable u on u.r = reach.s group by reach.r),
counted as (select a as r, count(*) as n from links group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, coalesce(vec_id = component_id, false) as kept
from usable join smallest using (r) left join counted using (r)
"""

ORACLES["op10_exact_dedup"] = """
with normal as (
  select doc_id, length(coalesce(text, '')) as points, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') as content
  from documents),
ranked as (
  select doc_id, content, row_number() over w as place, first_value(doc_id) over w as keep_id, count(*) over (partition by content) as group_size
  from normal window w as (partition by content order by points desc, doc_id nulls last))
select doc_id, keep_id, group_size, place = 1 as kept, sha256(content) as text_sha256 from ranked
"""

ORACLES["op13_source_audit"] = """
with docs as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms
  from documents),
words as (select r, lang, source, unnest(terms) as term from docs),
kept as (select lang, term, count(*) as n_term from words group by all having count(distinct r) >= 30),
counts as (select lang, source, term, count(*) as n from words join kept using (lang, term) group by all),
groups as (select distinct lang, source from docs),
langs as (
  select lang, count(term) as v, coalesce(sum(n_term), 0) as n_lang
  from (select distinct lang from groups) left join kept using (lang) group by lang),
sizes as (
  select lang, source, v, n_lang, coalesce(sum(n), 0) as n_group
  from groups join langs using (lang) left join counts using (lang, source) group by all),
shares as (
  select lang, source, term, coalesce(n, 0) as n,
         (1 + 1000000000::hugeint * (coalesce(n, 0) + 5) // (n_group + 5 * v))::bigint as p,
         (1 + 1000000000::hugeint * (n_term + 5) // (n_lang + 5 * v))::bigint as q
  from sizes join kept using (lang) left join counts using (lang, source, term)),
sums as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join sums on sums.lang = a.lang and sums.source = a.source and sums.item = b.source),
parts as (
  select * from pairs union all
  select lang, source, 'term', term, p - q from shares where n > 0 and p > q),
ranked as (select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank from parts)
select * from ranked where part = 'pair' or rank <= 50
"""
