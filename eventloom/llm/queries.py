"""The runnable queries of the corpus operators and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import chat, contamination, divergence, fertility, mixing, orderhash, paragraphs, resampling, secrets, suffixes, tokenfiles, urls, winnowing
from eventloom.llm.base import CHECKS, QUERIES, query, table

__all__ = ["CHECKS", "QUERIES"]

# Word class of the checked figures, and the rules for urls.
WORD_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
URL_RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

CONTAMINATION_SQL = rf"""
with item_words as (
  select cast(item_id as varchar) as item, regexp_extract_all({_LOWER}, '{WORD_CLASS}') as w from benchmark
  where item_id is not null
), windows as (
  select distinct item, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as phrase, least(10, len(w)) as n
  from (select item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from item_words where len(w) > 0)
), lengths as (select distinct n from windows),
doc_words as (select doc_id, regexp_extract_all({_LOWER}, '{WORD_CLASS}') as w from documents),
places as (
  select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as phrase
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from doc_words, lengths)
), found as (select doc_id, n, i, item from places join windows using (n, phrase)),
hit as (
  select doc_id, count(distinct k) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as k from (select distinct doc_id, n, i from found)) group by doc_id
), named as (
  select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items
  from found group by doc_id
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join hit using (doc_id) left join named using (doc_id)
"""


@query("op1_order_minhash")
def op1_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return orderhash.near_duplicates(table(spark, folder, "documents"))


@query("op2_decontamination", CONTAMINATION_SQL)
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination.find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return contamination.contamination_digest(found)


URLS_SQL = r"""
with u as (
  select page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
  from pages
), rules(verdict, h, p) as (
  values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fits as (
  select page_id, arg_max(h || p, length(h || p)) as rule, arg_max(verdict, length(h || p)) as verdict
  from u join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by page_id
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from u left join fits using (page_id)
"""


@query("op3_url_cascade", URLS_SQL)
def op3_url_cascade(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge_urls(table(spark, folder, "pages"), urls.rule_table(spark, URL_RULES))


ROTATION_SQL = r"""
with rows_ as (
  select conv_id, turn, coalesce(role, 'unknown') as speaker,
         regexp_replace(coalesce(text, ''), '<\|(im_start|im_end)\|>', '<| \1 |>', 'g') as text
  from conversations
), views as (select distinct conv_id as view_of, speaker as perspective from rows_ where speaker <> 'system'),
joined as (
  select *, speaker = 'system' as instructs, speaker = perspective as own
  from rows_ join views on conv_id is not distinct from view_of
), parts as (
  select *, case when instructs then speaker when own then 'assistant' else 'user' end as chat_role from joined
), heads as (
  select *, '<|im_start|>' || chat_role || case when instructs or own then '' else ' name=' || translate(
    regexp_replace(speaker, '<\|(im_start|im_end)\|>', '<| \1 |>', 'g'), chr(10) || chr(13), '  ') end || chr(10) as head
  from parts
)
select conv_id, perspective, turn, case when not instructs then speaker end as speaker, chat_role,
       head || text || '<|im_end|>' || chr(10) as segment,
       length(head) + length(text) + 11 as n_chars,
       length(head) as mask_start,
       length(head) + case when own and text <> '' then length(text) + 10 else 0 end as mask_end,
       own and text <> '' as in_loss
from heads
"""


@query("op7_perspective_rotation", ROTATION_SQL)
def op7_perspective_rotation(spark: SparkSession, folder: str) -> DataFrame:
    return chat.rotate_perspectives(table(spark, folder, "conversations"))


# Hexadecimal text stands for the bytes: two characters each.
SUBSTRINGS_SQL = """
with d as (
  select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents
), places as (
  select r, doc_id, i, substr(h, 2 * i + 1, 100) as piece
  from (select r, doc_id, h, unnest(range(0, cast(length(h) // 2 as bigint) - 49)) as i from d)
), least_ as (select piece, min(doc_id) as low from places group by piece),
hit as (select r, i from places join least_ using (piece) where doc_id > low),
marked as (select r, i, case when i <= lag(i) over (partition by r order by i) + 50 then 0 else 1 end as opens from hit),
runs as (
  select r, k, min(i) as a, max(i) + 50 as b
  from (select r, i, sum(opens) over (partition by r order by i) as k from marked) group by r, k
), gaps as (
  select r, k, a, b, coalesce(lag(b) over (partition by r order by a), 0) as before from runs
), cut as (
  select r, sum(b - a) as n_removed, count(*) as n_spans, max(b) as tail,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' order by a) as head
  from gaps join d using (r) group by r
)
select doc_id, cast(length(h) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
       coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(tail, 0) + 1))) as kept_sha256
from d left join cut using (r)
"""


@query("op8_suffix_dedup", SUBSTRINGS_SQL)
def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.span_digest(suffixes.repeated_spans(table(spark, folder, "documents")))


@query("op4_token_files")
def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokenfiles.read_token_files(tokenfiles.write_token_files(table(spark, folder, "documents")))


@query("op5_paragraph_bands")
def op5_paragraph_bands(spark: SparkSession, folder: str) -> DataFrame:
    return paragraphs.repeated_passages(table(spark, folder, "documents"))


@query("op6_tokeniser_fertility")
def op6_tokeniser_fertility(spark: SparkSession, folder: str) -> DataFrame:
    return fertility.judge_quality(table(spark, folder, "documents"))


@query("op9_secret_forest")
def op9_secret_forest(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, folder, "documents"))


@query("op10_raked_mix")
def op10_raked_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_decisions(table(spark, folder, "documents"))


# DuckDB has no crc32: a fold over the bytes (as hexadecimal digits) with the table of its polynomial.
RESAMPLING_SQL = rf"""
with recursive steps as (
  select i, i as v, 0 as k from range(256) as t(i)
  union all select i, case when v % 2 = 1 then xor(v // 2, 3988292384) else v // 2 end, k + 1 from steps where k < 8
), crc as (select list(v order by i) as effect from steps where k = 8),
doc_words as (select doc_id, regexp_extract_all({_LOWER}, '{WORD_CLASS}') as w from documents),
item_words as (select regexp_extract_all({_LOWER}, '{WORD_CLASS}') as w from benchmark),
doc_features as (
  select doc_id, unnest(w) as f from doc_words
  union all select doc_id, w[i] || ' ' || w[i + 1] from (select doc_id, w, unnest(range(1, len(w))) as i from doc_words)
), item_features as (
  select unnest(w) as f from item_words
  union all select w[i] || ' ' || w[i + 1] from (select w, unnest(range(1, len(w))) as i from item_words)
), named as (
  select f, hex(encode(f)) as h from (select distinct f from doc_features union select distinct f from item_features)
), placed as (
  select f, xor(list_reduce(
    [4294967295::bigint] || list_transform(range(1, length(h), 2), lambda i:
      ((instr('0123456789ABCDEF', substr(h, i, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(h, i + 1, 1)) - 1)::bigint),
    lambda c, b: xor(effect[xor(c % 256, b) + 1]::bigint, c // 256)), 4294967295::bigint) % 10000 as bucket
  from named, crc
), s as (select bucket, count(*) as s from doc_features join placed using (f) group by bucket),
t as (select bucket, count(*) as t from item_features join placed using (f) group by bucket),
totals as (
  select cast((select coalesce(sum(s), 0) from s) as double) as all_s, cast((select coalesce(sum(t), 0) from t) as double) as all_t
), gains as (
  select bucket, cast(floor(1000 * ln(((coalesce(t, 0) + 1) * (all_s + 10000)) / ((s + 1) * (all_t + 10000)))) as bigint) as gain
  from s left join t using (bucket), totals
), weights as (
  select doc_id, count(*) as n_features, cast(floor(sum(gain) / count(*)) as bigint) as weight
  from doc_features join placed using (f) join gains using (bucket) group by doc_id
), scored as (
  select doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
         coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((h + 0.5) / 4294967296::double))) as bigint) as score
  from (select *, cast('0x' || substr(sha256('7:' || doc_id), 1, 8) as bigint)::double as h from doc_words) left join weights using (doc_id)
), ranked as (
  select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id) as place,
         (25 * count(*) filter (where n_words >= 20) over ()) // 100 as wanted
  from scored
)
select doc_id, n_features, weight, score, case when n_words >= 20 and place <= wanted then place end as rank from ranked
"""


@query("op13_importance_resampling", RESAMPLING_SQL)
def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    sampled = resampling.importance_resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return sampled.select("doc_id", "n_features", "weight", "score", "rank")


DIVERGENCE_SQL = r"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
), t as (select r, lang, source, unnest(w) as term from d),
kept as (
  select lang, term from (select distinct r, lang, term from t) group by lang, term having count(*) >= 10
), c as (select lang, source, term, count(*) as c from t join kept using (lang, term) group by lang, source, term),
v as (select lang, count(*) as v from kept group by lang),
groups as (select distinct lang, source from d),
n as (select lang, source, sum(c) as n from c group by lang, source),
wholes as (select lang, source, coalesce(n, 0) + 2 * v as whole from groups join v using (lang) left join n using (lang, source)),
own as (
  select lang, source, term, coalesce(c, 0) as c, 1 + (1000000000::hugeint * (coalesce(c, 0) + 2)) // whole::hugeint as p
  from wholes join kept using (lang) left join c using (lang, source, term)
), every as (
  select lang, term, 1 + (1000000000::hugeint * (sum(c) + 2)::hugeint) // (sum(sum(c)) over (partition by lang) + 2 * any_value(v))::hugeint as q
  from own join v using (lang) group by lang, term
), pairs as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from own a join own b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by a.lang, a.source, b.source
), terms as (
  select lang, source, term as item, (p - q) * (p - q) // (p + q) as value from own join every using (lang, term) where c > 0 and p > q
), parts as (
  select g.lang, g.source, 'pair' as part, h.source as item, cast(coalesce(value, 0) as bigint) as value
  from groups g join groups h on g.lang = h.lang and g.source <> h.source
  left join pairs p on p.lang = g.lang and p.source = g.source and p.item = h.source
  union all select lang, source, 'term', item, cast(value as bigint) from terms
), ranked as (
  select *, cast(row_number() over (partition by lang, source, part order by value desc, encode(item)) as integer) as rank from parts
)
select * from ranked where part = 'pair' or rank <= 10
"""


@query("op12_source_divergence", DIVERGENCE_SQL)
def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit_sources(table(spark, folder, "documents"))


@query("op11_winnowing")
def op11_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    marks = winnowing.edit_audit(table(spark, folder, "documents"))
    return marks.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        winnowing.written_out("hashes", "positions").alias("fingerprint"),
        winnowing.written_out("edited_hashes", "edited_positions").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
