"""SQL counterparts of the dealt queries, where SQL can express them."""

from __future__ import annotations

from sitegrain.llm.licenses import oracle_sql
from sitegrain.llm.quality import BASE, RULES, mask

ORACLE: dict[str, str] = {}

ORACLE["op10_exact_dedup"] = """
with d as (select doc_id, coalesce(text, '') as text from documents)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(text) as text_sha256
from (select *, max(doc_id) over (partition by text) as keep_id, count(*) over (partition by text) as group_size from d)
"""

# Words taken have a closed form: whole rounds of the source's line, and the head of one more.
ORACLE["op4_mixing"] = r"""
with d as (
  select doc_id, coalesce('0' || source, '1') as s, md5(coalesce(cast(doc_id as varchar), '')) as h,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size
  from documents
), src as (
  select s, cast(sum(size) as bigint) as source_size,
         [5, 2, 1][(row_number() over (order by encode(s)) - 1) % 3 + 1] as w
  from d group by s
), o as (
  select *, 3 * source_size as lim, row_number() over (order by 3 * source_size / w, encode(s)) as place,
         cast(sum(source_size) over () as bigint)
           - coalesce(cast(sum(3 * source_size) over (order by 3 * source_size / w, encode(s) rows between unbounded preceding and 1 preceding) as bigint), 0) as rest,
         cast(sum(w) over (order by 3 * source_size / w, encode(s) rows between current row and unbounded following) as bigint) as shares
  from src
), f as (select min_by(rest, place) as rest, min_by(shares, place) as shares, min(place) as place from o where lim * shares >= rest * w),
t as (
  select s, source_size, case when o.place < f.place then cast(lim as double) else cast(w * f.rest as double) / f.shares end as target
  from o, f
), l as (
  select doc_id, s, size, coalesce(cast(sum(size) over (partition by s order by h, size rows between unbounded preceding and 1 preceding) as bigint), 0) as start
  from d
), w as (select *, cast(floor(target + 0.5) as bigint) as words from t)
select doc_id, size, source_size, target,
       case when size = 0 then 0 else
       (words // source_size) * size + greatest(0, least(start + size, words % source_size) - start) end as taken
from l join w using (s)
"""

ORACLE["op9_licenses"] = oracle_sql()

ORACLE["op3_quality"] = rf"""
with d as (select doc_id, coalesce(text, '') as text from documents),
s as (
  select doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
  from d
), w as (select doc_id, unnest(ws) as word, unnest(range(len(ws))) as pos from s),
g as (
  select doc_id, pos, concat_ws(' ', word, lead(word) over p, lead(word, 2) over p, lead(word, 3) over p, lead(word, 4) over p) as gram,
         lead(word, 4) over p is not null as whole
  from w window p as (partition by doc_id order by pos)
), r as (select doc_id, pos from (select *, count(*) over (partition by doc_id, gram) as n from g where whole) where n > 1),
rw as (select doc_id, count(distinct pos + k) as n from r, range(5) o(k) group by doc_id),
m as (
  select s.doc_id, len(ws) as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(rw.n, 0) as n_repeat_words, len(ls) as n_lines,
         len(list_filter(ws, lambda x: regexp_matches(x, '[A-Z]') and not regexp_matches(x, '[a-z]'))) as n_caps_words,
         len(regexp_extract_all(text, '!!')) as n_shouts, len(list_distinct(ws)) as n_distinct_words
  from s left join rw using (doc_id)
), l as (select *, {' + '.join(f"case when {r.fails} then {1 << r.bit} else 0 end" for r in RULES)} as failures from m)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
       cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words, cast(failures as bigint) as failures,
       failures & {mask(BASE)} <> 0 as base_failed, failures = 0 as kept
from l
"""

# Base32 takes five bits at a time; five hex digits are four characters.
ORACLE["op13_warc"] = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select *, sha1(html) as h, max(page_id) over (partition by html) as first, row_number() over (partition by html order by page_id desc) as place from p)
select page_id, cast(octet_length(encode(html)) as bigint) as payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::int >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') as payload_digest,
       case when place = 1 then 'response' else 'revisit' end as record_type, case when place > 1 then first end as refers_to
from d
"""

# The CRC's table, and the CRC of a text of ASCII letters in the column ``s``.
CRC_TABLE = """(select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
  lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as crc)"""
CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(s, ''), lambda x: ascii(x)::bigint)),
  lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])))"""

ORACLE["op11_prefix_trie"] = rf"""
with t as (
  select conv_id as c, turn, substr(sha256(concat(length(role), ':', role, text)), 1, 32) as d,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as w
  from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)
), own as (
  select c, cast(c as varchar) as s, list({{'d': d, 'w': w}} order by turn nulls first, d) as ts from t group by c
), heads as (select own.*, {CRC} % 4 as h from own, {CRC_TABLE}),
rebuilt as (
  select a.c, list_concat(coalesce(b.ts[1:a.h], []), a.ts[a.h + 1:]) as ts from heads a left join own b on b.c = a.c - a.c % 20
), steps as (select c, ts, unnest(range(len(ts) + 1)) as depth from rebuilt),
members as (
  select c, depth, array_to_string(list_transform(ts[1:depth], lambda x: x.d), '') as p,
         case when depth > 0 then ts[depth].w else 0 end as w, depth = len(ts) as ends
  from steps
), nodes as (
  select p, depth, min(c) as conv_id, count(*) as n_convs, (count(*) - 1) * max(w) as saved,
         sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (where ends), '')) as ends_sha256
  from members group by p, depth
), kids as (select substr(p, 1, 32 * (depth - 1)) as p, count(*) as n from nodes where depth > 0 group by 1),
up as (select nodes.*, coalesce(kids.n, 0) as n_children, unnest(range(depth + 1)) as k from nodes left join kids using (p)),
sums as (select substr(p, 1, 32 * k) as p, sum(saved) as saved_tokens, count(*) filter (where n_children = 0) as n_leaves from up group by 1)
select n.conv_id, n.depth, case when n.depth > 0 then a.conv_id end as parent_conv_id, n.n_convs, coalesce(kids.n, 0) as n_children,
       sums.n_leaves, cast(sums.saved_tokens as bigint) as saved_tokens, n.ends_sha256
from nodes n join sums using (p) left join kids using (p) left join nodes a on a.depth = n.depth - 1 and a.p = substr(n.p, 1, 32 * (n.depth - 1))
"""
