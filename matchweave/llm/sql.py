"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from matchweave.llm.sharding import KEY_BITS, SHARD_BYTES
from matchweave.llm.url_filter import SITES, UNWANTED

OP2 = f"""
with items as (
  select doc_id, coalesce(strlen(text), 0) as n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, {KEY_BITS // 4}))::bigint as code
  from documents),
depths as (select unnest(range(0, {KEY_BITS + 1})) as depth),
sizes as (
  select depth, code >> ({KEY_BITS} - depth) as bucket, sum(n_bytes)::bigint as shard_bytes, count(*) as shard_docs
  from items, depths group by 1, 2),
placed as (
  select doc_id, n_bytes, s.depth, bucket, shard_bytes, shard_docs,
         row_number() over (partition by doc_id order by s.depth) as nth
  from items join sizes s on bucket = code >> ({KEY_BITS} - s.depth)
  where shard_bytes <= {SHARD_BYTES} or shard_docs = 1)
select doc_id, n_bytes, case when depth = 0 then '' else lpad(bin(bucket), depth::int, '0') end as shard,
       depth::bigint as depth, shard_bytes, shard_docs
from placed where nth = 1
"""

_SITE_ROWS = ", ".join(
    f"('{site}', '{verdict}', '{site.partition('/')[0]}', '/{site.partition('/')[2]}')" for verdict, site in SITES
)

OP10 = f"""
with site(rule, verdict, rhost, rpath) as (values {_SITE_ROWS}),
rest as (
  select page_id, url, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
parts as (
  select page_id, url,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from rest),
best as (
  select page_id, url, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict
  from parts join site on (host = rhost or host like '%.' || rhost) and starts_with(path, rpath)
  group by page_id, url)
select p.page_id, p.host, p.path, b.rule,
       coalesce(b.verdict, case when regexp_matches(lower(p.host || p.path), '(^|[^a-z0-9])({"|".join(UNWANTED)})([^a-z0-9]|$)')
                           then 'block' else 'allow' end) as verdict
from parts p left join best b on p.page_id = b.page_id and p.url is not distinct from b.url
"""

OP6 = """
with usable as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from usable q join usable c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id),
ranked as (
  select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from scored)
select * from ranked where rank <= 5
"""

#: CRC-32 of the UTF-8 bytes of code points below 2048, from the table that its polynomial gives.
OP12 = r"""
with recursive crc(t) as (
  select list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end))),
runs as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as k
  from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) as run from documents)
  group by all),
bytes as (
  select run, k, flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''),
         lambda c: case when unicode(c) < 128 then [unicode(c)::bigint]
                   else [192 + (unicode(c)::bigint >> 6), 128 + (unicode(c)::bigint & 63)] end)) as b
  from runs),
checked as (
  select run, k, xor(list_reduce([4294967295::bigint] || b, lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) as h
  from bytes, crc),
words as (
  select case when h % 97 = 0 then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2) else run end as word,
         sum(k)::bigint as n
  from checked group by 1 having length(word) >= 5 and sum(k) >= 3),
cut as (
  select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
  from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
near as (
  select a.word, a.n, b.word as other, b.n as other_n from cut a join cut b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union
  select a.word, a.n, b.word, b.n from cut a join words b on a.rest = b.word
  union
  select b.word, b.n, a.word, a.n from cut a join words b on a.rest = b.word),
best as (
  select word, n, count(*) as n_near, first(other order by other_n desc, other) as other, max(other_n) as other_n from near group by word, n),
forms as (
  select word, n_near, case when other_n >= 2 * n then other end as form, case when other_n >= 2 * n then other_n end as form_n from best),
steps(word, place, nth) as (
  select word, form, 1 from forms where form is not null
  union all
  select s.word, f.form, s.nth + 1 from steps s join forms f on f.word = s.place where f.form is not null),
ends as (select word, arg_max(place, nth) as root from steps group by word)
select w.word, w.n, coalesce(f.n_near, 0) as n_near, f.form, f.form_n, coalesce(e.root, w.word) as root
from words w left join forms f on f.word = w.word left join ends e on e.word = w.word
"""

OP13 = """
with usable as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_inner_product(a.v, c.v)::bigint as score
  from usable a join usable c on a.vec_id % 100 = 0 and a.vec_id <> c.vec_id),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.positive_id,
       row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id)::int as rank,
       s.vec_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scored s on s.anchor_id = p.anchor_id and not s.same
  and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score
qualify rank <= 10
"""

SQL = {"op12_spelling_variants": OP12, "op13_hard_negatives": OP13, "op6_block_topk": OP6, "op2_extendible_shards": OP2, "op10_url_rules": OP10}
