"""DuckDB statements for the queries that SQL can express."""

WORDS = r"'[^\x20\x09-\x0D]+'"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SUFFIX_REPEATS = f"""
with split as (select doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) as ws from documents),
windows as (
  select doc_id, i, array_to_string(ws[i : i + 12], ' ') as w from split, unnest(range(1, len(ws) - 11)) as t(i)),
firsts as (select w, min(doc_id) as first from windows group by w),
repeats as (select doc_id, i from windows join firsts using (w) where first < doc_id),
gone as (select distinct doc_id, i + k as i from repeats, unnest(range(0, 13)) as t(k)),
words as (select doc_id, i, ws[i] as word from split, unnest(range(1, len(ws) + 1)) as t(i)),
kept as (
  select doc_id, count(*) as n, string_agg(word, ' ' order by i) as text from words anti join gone using (doc_id, i)
  group by doc_id)
select doc_id, len(ws) as n_words, len(ws) - coalesce(n, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from split left join kept using (doc_id)"""

NGRAM_JOIN = f"""
with recursive split as (select doc_id, regexp_extract_all({LOWERED}, {WORDS}) as ws from documents),
shingles as (
  select distinct doc_id, array_to_string(ws[i : i + 4], ' ') as g
  from split, unnest(range(1, greatest(len(ws) - 3, least(len(ws), 1) + 1))) as t(i)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from shingles a join shingles b on a.g = b.g and a.doc_id < b.doc_id
  group by all),
links as (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * c >= 80 * (x.n + y.n - c)),
both_ways as (select a, b from links union all select b, a from links),
reached as (
  select doc_id as a, doc_id as b from documents union
  select reached.a, both_ways.b from reached join both_ways on reached.b = both_ways.a)
select doc_id, coalesce(n, 0) as n_shingles, component_id
from documents left join sizes using (doc_id) join (select a as doc_id, min(b) as component_id from reached group by a)
using (doc_id)"""
