"""The same results in SQL over the tables themselves, for DuckDB."""

from __future__ import annotations

from checks.queries import BUDGET, PATHS

SITE = "https://www.example.com"
HOSTS = "('blog.tionsh.example.net', 'thther.example.org')"


def _bare(url: str) -> str:
    return rf"regexp_replace(regexp_replace({url}, '[?#].*$', ''), '/+$', '')"


HOST = "regexp_extract(url, '://([^/?#]*)', 1)"
ORIGIN = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"
PATH = rf"regexp_replace(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/+$', '')"


def _text(x: str) -> str:
    """Entities and blanks of the test pages."""
    for entity, char in (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{char}')"
    x = f"regexp_replace({x}, '&amp$', '&')"
    return rf"nullif(trim(regexp_replace({x}, '\s+', ' ', 'g')), '')"


HREFS = """(select distinct page_id, url, replace(trim(h), '&amp;', '&') as href
 from (select page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as h from pages))"""
LINKS = f"(select distinct page_id, {_bare(ORIGIN + ' || href')} as url, {HOST} as host, {_bare('url')} as src from {HREFS})"

K, S = "p_partkey", "s_suppkey"
PRODUCT_URL = f"'{SITE}/en/champagnes-et-cuvees/part-' || {K}"
NAME = f"case when {K} % 13 = 0 then 'Reserve ' || p_name else p_name end || case when {K} % 11 = 0 then '' else ' ' || p_brand end"
NAMED = f"{K} % 17 <> 5"
BEST = f"'{SITE}/img/' || {K} || case when p_size * 100 > 320 then '-l.jpg' else '-s.jpg?q=1' end"
BRAND_IMAGE = f"'{SITE}/img/' || replace(p_brand, '#', '-') || '.png?b=1'"
VIDEO = f"'{SITE}/video/' || p_size || '.mp4'"
BACKGROUND = f"'{SITE}/bg/' || ({K} % 10) || '.jpg'"
MEDIA = f"""(select {K}, 'image' as media_type, {BEST} as url, 0 as pos from part where {NAMED}
 union all select {K}, 'image', {BRAND_IMAGE}, 1 from part where {NAMED}
 union all select {K}, 'video', {VIDEO}, 2 from part where {NAMED}
 union all select {K}, 'image', {BACKGROUND}, 3 from part where {NAMED})"""
CARD = f"{K} % 7 <> 0 and {K} % 6 <> 1"
DOSAGE = f"case when {K} % 4 = 0 then 1.0 else p_size + 0.5 end"

LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice"
STATUS = "case when o_orderstatus = 'P' then '' else o_orderstatus end"
ORDERS = f"(select *, {STATUS} as status from orders)"


def _row(*columns: str) -> str:
    """An ordering value."""
    return "row(" + ", ".join(columns) + ")"


LINE_ROW = _row(LINE_ORDER)
O_ROW = _row("o_orderdate", "o_orderkey")
P_ROW = _row("l_shipdate", "l_orderkey", LINE_ORDER)
CLOSURE = f"""closure(k, wave) as (
  select cast(0 as bigint), 1 union
  select p.{K}, t.wave + 1 from closure t join part p on p.{K} in (2 * t.k + 1, 2 * t.k + 2) where t.k % 17 <> 5)"""
# The links of the page under the URL x.k, where there is one and it yields anything.
NUMBER = "cast(nullif(regexp_extract(x.k, '/part-([0-9]+)$', 1), '') as bigint)"
CHILDREN = f"""case when x.k like '%/fr/%' then ['{SITE}/en/champagnes-et-cuvees/part-0']
 when list_contains(ks, {NUMBER}) and {NUMBER} % 17 <> 5 then ['{SITE}/en/champagnes-et-cuvees/part-' || (2 * {NUMBER} + 1),
 '{SITE}/en/champagnes-et-cuvees/part-' || (2 * {NUMBER} + 2), '{SITE}/en'] else [] end"""
FIRST_LINES = f"""(select l_orderkey, l_returnflag, l_linestatus, min({LINE_ROW}) as o, arg_min(l_quantity, {LINE_ROW}) as q
 from lineitem group by all)"""
PAGE_ERRORS = f"select {K} as page_id, {PRODUCT_URL} as url, 'product' as stage, 'product page without a name' as message from part where not ({NAMED})"
STORED = f"""(select sha256('https://h.example.com/p/' || {K}) as id, p_name as name, 'https://h.example.com/p/' || {K} as product_url,
 'https://h.example.com/p/' || {K} || '?old' as source_page_url, p_type as description, p_size as dosage,
 case when {K} % 5 = 0 then p_brand end as aging, {K}, p_brand from part)"""


def _path_rows() -> str:
    rows = []
    for i, (path, (product, catalog, house, cls)) in enumerate(PATHS.items()):
        low = path.lower()
        winery = "history" if "/maison/histoire" in low else "family_spirit" if "/maison/famille" in low else "winery"
        rows.append(f"({i}, {product} = 1, {catalog} = 1, {house} = 1, '{winery}', {'null' if cls is None else repr(cls)})")
    return ", ".join(rows)


ORACLE: dict[str, str] = {
    "url_normalize": f"select page_id, {_bare('url')} as key from pages",
    "url_media_normalize": r"""select page_id, regexp_replace(regexp_replace(url, '#.*$', ''), '/+(\?|$)', '\1') as key from pages""",
    "url_canonical": f"select page_id, '{SITE}' || {PATH} as canon from pages",
    "url_parts": f"select page_id, {HOST} as host, {PATH} as path from pages",
    "url_slug": f"select page_id, nullif(regexp_extract({PATH}, '([^/]*)$', 1), '') as slug from pages",
    "url_absolute": f"""with b as (select page_id, {ORIGIN} as o, regexp_replace(url, '[?#].*$', '') as p, regexp_replace(url, '#.*$', '') as q,
 regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '') as d from pages)
 select page_id, n, case n when 0 then o || '/r/' || page_id when 1 then d || 'x.html'
 when 2 then case when d = o || '/' then d else regexp_replace(d, '[^/]+/$', '') end || 'up'
 when 3 then p || '?p=2' when 4 then q || '#frag' when 5 then regexp_extract(o, '^([a-z]+:)', 1) || '//cdn.example.com/a'
 when 6 then case when o like 'https:%' then 'https://cdn.example.com/b' else 'HTTPS://cdn.example.com/b' end else '' end as target
 from b, range(8) t(n)""",
    "url_internal": f"select page_id, url from pages where {HOST} in {HOSTS}",
    "url_in_scope": f"select page_id, url from pages where {PATH} in ('/en', '/fr/1') or {PATH} like '/en/%' or {PATH} like '/fr/1/%'",
    "links_discovered": f"select page_id, url from {LINKS}",
    "links_catalog_rule": f"select page_id, url from {LINKS} where host in {HOSTS}",
    "links_distinct": f"select url from {LINKS} union select {_bare('url')} from pages",
    "link_dedupe_ratio": f"""select count(*) as seen, count(distinct url) as unique_urls, count(*) - count(distinct url) as duplicates,
 (count(*) - count(distinct url)) / count(*) as dedupe_ratio from {LINKS}""",
    "links_in_scope": f"select page_id, url from (select page_id, url, {PATH} as p from {LINKS}) where p = '/en' or p like '/en/%'",
    "link_report": f"""select host, count(distinct page_id) as pages, count(*) as links, count(distinct url) as distinct_links,
 round((count(*) - count(distinct url)) / count(*), 6) as dedupe_ratio from {LINKS} group by host""",
    "page_language": rf"""select page_id, lang, lang like 'fr%' or {PATH} = '/fr' or {PATH} like '/fr/%' as is_fr,
 lang like 'en%' or {PATH} = '/en' or {PATH} like '/en/%' as is_en
 from (select page_id, url, regexp_extract(html, '<html lang="(\w+)"', 1) as lang from pages)""",
    "route_language": f"""select {K} + 1000000000 as page_id, true as routed, case {K} % 5 when 0 then {PRODUCT_URL}
 when 1 then '{SITE}/en/part-' || {K} when 2 then '{SITE}/english/' || {K} else '' end as links from part""",
    "language_switch_german": f"""select {K} + 1000000000 as page_id, case when {K} % 5 = 3 then '{SITE}/de/part-' || {K} end as target from part""",
    "page_classify": rf"""select page_id, case when regexp_matches(p, '^/en/[0-9]+\.html$') then 'product'
 when regexp_matches(p, '^/de/[0-9]+$') then 'catalog' when contains(p, '/en/1') then 'history' when contains(p, '/en/2') then 'family_spirit'
 when regexp_matches(p, '^/es/[0-9]+(\.html)?$') or p in ('/fr/1', '/fr/2') then 'winery' end as page_class from (select page_id, {PATH} as p from pages)""",
    "page_type_rules": f"""select {K}, r.is_product, r.is_catalog, r.is_winery, r.winery_class, r.page_class from part join (values {_path_rows()})
 r(n, is_product, is_catalog, is_winery, winery_class, page_class) on {K} % {len(PATHS)} = r.n""",
    "dedupe_final_url": f"""select 'https://blog.tionsh.example.net' || {PATH} as canon, min(page_id) as page_id from pages group by 1""",
    "page_title": f"select page_id, {_text('''regexp_extract(html, '(?s)<title>(.*?)</title>', 1)''')} as title from pages",
    "page_heading": f"select page_id, {_text('''regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)''')} as heading from pages",
    "page_paragraph_count": "select page_id, len(regexp_extract_all(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<p>')) as paragraphs from pages",
    "page_element_counts": r"""select lower(tag) as tag, count(*) as n from
 (select unnest(regexp_extract_all(regexp_replace(html, '(?s)<script>.*?</script>', '<script>', 'g'), '<([a-zA-Z][a-zA-Z0-9]*)', 1)) as tag from pages) group by 1""",
    "text_numbers": r"""with d as (select doc_id, text, regexp_extract_all(text, '[0-9]+(?:[.,][0-9]+)?') as n from documents)
 select doc_id, try_cast(replace(n[1], ',', '.') as double) as number, try_cast(regexp_extract(text, '[0-9]{4}') as integer) as year,
 case when not (contains(lower(text), 'non-vintage') or contains(lower(text), 'non vintage') or trim(lower(text)) = 'nv')
 then try_cast(regexp_extract(text, '[0-9]{4}') as integer) end as vintage,
 try_cast(replace(n[1], ',', '.') as double) as low, try_cast(replace(coalesce(n[2], n[1]), ',', '.') as double) as high from d""",
    "product_roundtrip": f"""select {K}, {NAME} as name, {PRODUCT_URL} as product_url, {PRODUCT_URL} as source_page_url,
 p_type || ' size ' || p_size || ' cm' as description, cast({DOSAGE} as double) as dosage_g_per_l, ({K} % 7 + 1) || ' years' as aging,
 '8-' || (p_size % 5 + 9) || ' C' as operating_temperature, p_type as crus_assembles, cast({K} % 20 + 2000 as varchar) as millennium,
 cast(p_size as double) as grape_chardonnay_percent, p_size + 1.5::double as grape_pinot_noir_percent,
 case when {K} % 3 <> 0 then cast(p_size + 2 as double) end as grape_meunier_percent,
 case when {K} % 9 <> 0 then '{SITE}/docs/part-' || {K} || '.pdf' end as data_sheet_url from part where {NAMED}""",
    "product_grape_pairs": f"select {K}, 99.0::double as grape_chardonnay_percent from part where {NAMED}",
    "awards_roundtrip": f"""select {K}, 0 as n, p_brand as title, cast(p_retailprice as varchar) as value from part where {NAMED}
 union all select {K}, 1, 'Guide', '' from part where {NAMED}""",
    "tasting_roundtrip": f"select {K}, 'Nose' as title, p_type as content from part",
    "page_errors": PAGE_ERRORS,
    "media_roundtrip": f"select {K}, media_type, url from {MEDIA}",
    "media_kinds": f"select {K} as page_id, 4 as media_count, 3 as images, 1 as videos, 1 as backgrounds from part",
    "media_type_counts": f"select media_type, count(*) as n from {MEDIA} group by 1",
    "links_roundtrip": f"""select {K}, '{SITE}/en/champagnes-et-cuvees/part-' || ({K} * 2 + i) as url from part, range(1, 3) t(i) where {NAMED}
 union all select {K}, '{SITE}' || p from part, (values ('/en'), ('/legal/terms')) v(p) where {NAMED}
 union all select {K}, '{SITE}/docs/part-' || {K} || '.pdf' from part where {NAMED} and {K} % 9 <> 0""",
    "srcset_best": f"select {K}, case when p_size * 20 > 320 then '/b/' else '/a/' end || {K} || '.jpg' as best from part",
    "listing_cards": f"""select p_name as name, {PRODUCT_URL} as product_url, '{SITE}/en/list/' || ({K} // 10) as source_page_url,
 'listed ' || p_type as description from part where {CARD}""",
    "listing_media": f"select '{SITE}/img/' || {K} || '-card.jpg' as url, '{SITE}/en/list/' || ({K} // 10) as source_page_url from part where {CARD}",
    "house_description": f"""select '{SITE}/en/engagements/' || {S} as source_page_url, 'House of ' || s_name || ' since ' || ({S} % 200 + 1800) as description from supplier""",
    "house_history": f"""with m as (select {S}, 0 as i, ({S} % 200 + 1800) || ' - Start' as year, s_name || ' opens' as event from supplier
 union all select {S}, 1, ({S} % 200 + 1810) || ' - Cellar', s_name || ' opens' from supplier where {S} % 2 = 0
 union all select {S}, 2, ({S} % 200 + 1820) || ' - Award', 'Medal ' || {S} from supplier where {S} % 3 = 0)
 select '{SITE}/en/maison/histoire/' || {S} as source_page_url, row_number() over (partition by {S} order by i) - 1 as n, year, event from m""",
    "house_family": f"""select '{SITE}/en/maison/famille/' || {S} as source_page_url, 'Jean-claude S' || lower(s_name[2:]) as member, 'first' || chr(10) || s_name as text from supplier
 union all select '{SITE}/en/maison/famille/' || {S}, 'Anne', 'late ' || {S} from supplier""",
    "rule_report": f"""with r(rule, applies, filled, media, links) as (
 select unnest(['product_name', 'product_description', 'left_sheet', 'right_sheet', 'data_sheet', 'awards', 'tasting', 'media', 'page_links']),
 unnest([n, n, n, n, sheets, n, n, n, n]), unnest([named, n, n, n, sheets, n, n, 0, 0]), unnest([0, 0, 0, 0, 0, 0, 0, 4 * n, 0]),
 unnest([0, 0, 0, 0, 0, 0, 0, 0, 4 * n + sheets])
 from (select count(*) as n, count(*) filter ({NAMED}) as named, count(*) filter ({K} % 9 <> 0) as sheets from part))
 select rule, (select count(*) from part) as pages, applies, filled, media, links, 0 as failed from r""",
    "custom_rule": f"""select {K}, 'field' as kind, 'size ' || p_size as value from part where {NAMED}
 union all select {K}, 'media', '{SITE}/plain/' || p_size || '.png' from part where {NAMED}
 union all select {K}, 'link', '{SITE}/size/' || p_size from part where {NAMED}""",
    "rule_errors": f"""select {K}, 'aging' as kind, case when p_size % 5 = 0 then ({K} % 7 + 1) || ' years' else (100 // (p_size % 5)) || ' months' end as value
 from part where {NAMED} union all select {K}, 'rule months', 'ZeroDivisionError' from part where p_size % 5 = 0""",
    "last_non_empty": f"""select o_custkey, coalesce(arg_max(status, {O_ROW}) filter (status <> ''), '') as status,
 arg_max(o_orderpriority, {O_ROW}) as priority from {ORDERS} group by 1""",
    "union_list_by_key": f"""select l_orderkey, string_agg(l_returnflag || '-' || l_linestatus || '-' || q, ' ' order by o) as items from {FIRST_LINES} group by 1""",
    "merge_awards": f"select l_orderkey, count(*) as n_awards, arg_min(l_returnflag, o) as first_title from {FIRST_LINES} group by 1",
    "merge_map": f"""with f as (select o_custkey, min({O_ROW}) as first from orders group by 1)
 select * from (select o.o_custkey, o_orderpriority as priority,
 coalesce(arg_max(status, {O_ROW}) filter (status <> ''), max(status) filter ({O_ROW} = first)) as status from {ORDERS} o join f using (o_custkey) group by 1, 2)
 where status is not null""",
    "merge_by_type": f"""select {K}, case when {K} % 2 = 0 then p_brand else p_type end as text, case when {K} % 3 = 0 then 0.0 else cast(p_size as double) end as number,
 concat_ws(',', '1', case when p_size <> 1 then p_size end, case when {K} % 5 not in (1, p_size) then {K} % 5 end) as years,
 case when {K} % 2 = 0 then p_brand else 'x' end as a, 'y' as b from part""",
    "seeded_house": f"""select 'Example House' as name, '{SITE}/' as website_url, '{SITE}/en/maison/famille/' || max({S}) as source_page_url,
 'House of ' || arg_max(s_name, {S}) || ' since ' || (max({S}) % 200 + 1800) as description, 3 * count(*) + 1 as n_records from supplier""",
    "table_defaults": "select n_name as name, 0 as members, 0 as milestones, cast(null as varchar) as description, true as created, true as fresh from nation",
    "batch_flushes": f"""select 'r1' as run_id, 3 as batch_flushes, 0 as written_wineries, 0 as written_products,
 cast(sum(n) as bigint) as written_media from (select count(distinct {K} // 2) as n from part, range(3) b(i) where {K} % 3 >= i group by i)""",
    "stream_dedupe_first": f"select url, any_value(media_type) as media_type, '{SITE}/en/champagnes-et-cuvees/part-' || min({K}) as source_page_url from {MEDIA} group by 1",
    "merge_two_maps": f"""with h as (select o_custkey, o_orderpriority as priority, min(status) filter (o_orderkey % 2 = 0) as a, min(status) filter (o_orderkey % 2 = 1) as b
 from {ORDERS} group by 1, 2) select o_custkey, priority, coalesce(nullif(b, ''), a) as status from h where a is not null or b <> ''""",
    "group_wineries": f"""with p as (select {S} as s, case when {S} % 2 = 0 then upper(n_name) else lower(n_name) end as n, lower('house ' || n_name) as name_key,
 s_name, s_acctbal from supplier join nation on s_nationkey = n_nationkey),
 y as (select name_key, cast(s % 7 as varchar) as year, min(s) as s from p group by 1, 2), l as (select name_key, string_agg(year, ',' order by s) as years from y group by 1)
 select name_key, ' House ' || arg_min(n, s) || ' ' as name, 'p' || max(s) as source_page_url, arg_max(s_name, s) filter (s_acctbal > 5000) as description,
 coalesce(arg_max(s_name, s) filter (s % 3 <> 0), case when min(s) % 3 = 0 then '' end) as last_member,
 any_value(years) as years, count(*) as n_records from p join l using (name_key) group by 1""",
    "group_products": f"""with p as (select *, 'https://h.example.com/p/' || l_partkey as url_key, {P_ROW} as o from lineitem),
 a as (select url_key, l_returnflag || l_linestatus as award, min(o) as o from p group by 1, 2),
 l as (select url_key, string_agg(award, ' ' order by o) as awards from a group by 1)
 select url_key, any_value('part ' || l_partkey) as name, 'https://h.example.com/o/' || arg_max(l_orderkey, o) as source_page_url,
 arg_max(l_linestatus, o) filter (l_returnflag = 'A') as description, arg_max(l_quantity, o) filter (l_returnflag = 'N') as dosage_g_per_l,
 cast(arg_max(l_suppkey, o) filter (l_returnflag = 'R') as varchar) as aging, '' as operating_temperature, arg_max(l_discount, o) as grape_chardonnay_percent,
 any_value(awards) as awards, count(*) as n_records from p join l using (url_key) group by 1""",
    "required_fields": f"select status, count(*) as n from {ORDERS} where status <> '' and o_orderpriority <> '' group by 1",
    "dedupe_run_products": f"""select l_orderkey, 'https://h.example.com/p/' || (l_partkey % 10) || '/' as product_url, arg_min(l_quantity, {_row('l_shipdate', LINE_ORDER)}) as l_quantity
 from lineitem group by 1, 2""",
    "dedupe_run_media": f"select url, any_value(media_type) as media_type, '{SITE}/en/champagnes-et-cuvees/part-' || min({K}) as source_page_url from {MEDIA} group by 1",
    "dedupe_run_wineries": f"select min(page_id) as page_id, arg_min(url, page_id) as source_page_url from pages group by {_bare('url')}",
    "completeness_score": f"""select {K}, cast(p_size % 2 = 0 and p_name <> '' as int) + cast(p_size % 3 = 0 as int) + 1 + cast(p_size % 5 = 0 as int) as score from part""",
    "upsert_merge": f"""with b as (select {K} as k, 'w2' as winery_id, p_name || ' new' as name, 's' as source_page_url, case when {K} % 2 = 0 then '' else 'fresh' end as description,
 case when {K} % 4 = 0 then round(p_size + 0.13, 2) end as dosage, '2 years' as aging, p_brand as brand from part where {K} % 3 <> 1),
 e as (select {K} as k, * from {STORED} where {K} % 3 <> 0)
 select sha256('https://h.example.com/p/' || coalesce(b.k, e.k)) as id, coalesce(b.winery_id, 'w1') as winery_id, coalesce(b.name, e.name) as name,
 'https://h.example.com/p/' || coalesce(b.k, e.k) as product_url, coalesce(b.source_page_url, e.source_page_url) as source_page_url,
 case when e.k is null then b.description else coalesce(nullif(b.description, ''), e.description) end as description, cast(coalesce(b.dosage, e.dosage) as double) as dosage, coalesce(b.aging, e.aging) as aging,
 case when e.k is not null then '' end as millennium,
 case when b.k is null then e.p_brand || '=1' when e.k is null then b.brand || '= 1;G=2' else e.p_brand || '=1;G=2' end as awards from b full join e on b.k = e.k""",
    "upsert_wineries": """with n as (select n_nationkey as k, n_name from nation),
 r as (select n_name, k % 3 <> 0 as old, k % 3 <> 1 as new, k, case when k % 2 = 0 then 'new' else '' end as t from n)
 select sha256(n_name) as id, n_name as name, case when new and t <> '' then t when old then 'old' else t end as description,
 case when not new then 'old' when not old then t when t = '' then 'old' else t end as k,
 case when not new then cast(k as varchar) when not old then cast(k % 2 as varchar) when k = k % 2 then cast(k as varchar) else k || ',' || (k % 2) end as years from r""",
    "upsert_replace": """select s_suppkey, case when s_suppkey % 2 = 0 then s_name || '*' else s_name end as s_name,
 case when s_suppkey % 2 = 0 then s_nationkey + 100 else s_nationkey end as s_nationkey,
 s_acctbal from supplier
 union all select s_suppkey + 1000000, s_name || '*', s_nationkey + 100, 0.0 from supplier where s_suppkey % 2 = 1""",
    "resolve_parent": "select s_suppkey, case when s_suppkey % 2 = 0 then cast(s_nationkey as varchar) else '7' end as winery_id from supplier",
    "read_existing": "select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_orderpriority = '1-URGENT')",
    "resolve_ids": f"select product_url, id from {STORED}",
    "list_products": f"select name, product_url, aging from {STORED} order by product_url limit 10",
    "show_product": f"select name, product_url, description, cast(dosage as double) as dosage from {STORED} where name = 'red widget'",
    "constraint_audit": """with w as (select cast(n_nationkey as varchar) as id, 'R' || n_regionkey as name, n_nationkey > 3 as ok from nation),
 p as (select cast(s_suppkey as varchar) as id, cast(s_nationkey * 2 as varchar) as winery_id, case when s_suppkey > 1 then 'n' end as name, s_name as product_url from supplier),
 m as (select cast(p_partkey as varchar) as id, case when p_size > 25 then 'image' when p_size > 5 then 'video' else 'audio' end as media_type, p_name as url from part),
 none(c) as (values ('winery.name not null'), ('winery.website_url not null'), ('winery.family_spirit not null'), ('winery.history_timeline not null'),
 ('product.product_url not null'), ('product.source_page_url not null'), ('product.awards_and_ratings not null'), ('media.media_type not null'), ('media.url not null'), ('media.source_page_url not null'))
 select c as constraint, 0 as violations, cast(null as varchar) as sample from none
 union all select 'winery.source_page_url not null', count(*), min(id) from w where not ok
 union all select 'product.name not null', count(*), min(id) from p where name is null
 union all select 'winery(name) unique', count(*), min(name) from (select name from w group by 1 having count(*) > 1)
 union all select 'product(product_url) unique', count(*), min(product_url) from (select product_url from p group by 1 having count(*) > 1)
 union all select 'product(winery_id, name) unique', count(*), min(x) from (select winery_id || '|' || name as x from p where name is not null group by 1 having count(*) > 1)
 union all select 'media(url) unique', count(*), min(url) from (select url from m group by 1 having count(*) > 1)
 union all select 'media.media_type known', count(*), min(url) from m where media_type = 'audio'
 union all select 'product.winery_id references winery', count(*), min(product_url) from p where winery_id not in (select id from w)
 union all select 'winery names alike', count(*), min(n) from (select lower(name) as n from w group by 1 having count(*) > 1)""",
    "number_overflow": """select 'dosage_g_per_l' as field, count(*) as n, min(l_extendedprice) as smallest from lineitem where l_extendedprice >= 9999.995
 union all select 'grape_meunier_percent', count(*), min(l_quantity * 25) from lineitem where l_quantity * 25 >= 999.995""",
    "cascade_delete": """select s_suppkey, case when s_suppkey % 5 > 0 then cast(s_nationkey as varchar) end as winery_id from supplier
 where s_suppkey % 5 = 0 or s_nationkey not in (select n_nationkey from nation where n_regionkey = 2)""",
    "frontier_closure": f"""with recursive {CLOSURE} select '{SITE}/fr/part-0' as key, 0 as wave
 union all select '{SITE}/en/champagnes-et-cuvees/part-' || k, wave from closure""",
    "frontier_accounting": f"""with recursive {CLOSURE}, live as (select k from closure where k % 17 <> 5),
 targets as (select cast(2 * k + i as varchar) as t from live, range(1, 3) r(i) union all select 'en' from live union all select '0')
 select count(*) + 1 as seen, count(distinct t) + 1 as unique_urls, count(*) - count(distinct t) as duplicates from targets""",
    "frontier_budget": f"""with recursive r(wave, pending, known) as (
 select 0, [{{'w': 0, 'h': md5('{SITE}/fr/part-0'), 'k': '{SITE}/fr/part-0'}}], ['{SITE}/fr/part-0']
 union all select wave + 1, list_concat(s[{BUDGET} + 1:], list_transform(fresh, lambda u: {{'w': wave + 1, 'h': md5(u), 'k': u}})), list_concat(known, fresh)
 from (select wave, s, known, list_filter(list_distinct(flatten(list_transform(s[1:{BUDGET}], lambda x: {CHILDREN}))), lambda u: not list_contains(known, u)) as fresh
  from (select wave, list_sort(pending) as s, known, ks from r, (select list({K}) as ks from part) where len(pending) > 0)))
 select t.k as key, wave from (select wave, unnest(list_sort(pending)[1:{BUDGET}]) as t from r where len(pending) > 0)""",
    "frontier_add_many": f"""select count(distinct url) as added from {LINKS} where url not in (select {_bare('url')} from pages
 union all select {ORIGIN} || '/the' from pages)""",
    "ingest_metrics": """select count(*) as total_requests, count(*) filter (event_type <> 'error') as success_requests, count(*) filter (event_type = 'error') as failed_requests,
 count(distinct user_id) filter (event_type <> 'error') as crawled_pages, round(count(*) filter (event_type = 'error') / count(*), 6) as error_rate,
 round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6), 6) as requests_per_s,
 round(quantile_cont(value, 0.95), 6) as p95_latency_s from events""",
    "ingest_metrics_last_n": """select count(distinct user_id) filter (event_type <> 'error') as crawled_pages,
 (select round(quantile_cont(value, 0.95), 6) from (select value from events order by ts desc, event_id desc limit 500)) as p95_latency_last_500_s from events""",
    "p95_latency_last_n": "select round(quantile_cont(value, 0.95), 6) as p95 from (select value from events order by ts desc, event_id desc limit 10000)",
    "latest_attempts": "select event_id as attempt_id, value as latency_s from events order by ts desc, event_id desc limit 50",
    "processed_pages": f"select count(*) filter ({NAMED}) as pages from part",
    "written_counts": f"""select 'wineries' as entity, 3 * count(*) as written from supplier
 union all select 'products', count(*) filter ({NAMED}) + count(*) filter ({CARD}) from part
 union all select 'media', (select count(distinct url) from {MEDIA}) + (select count(*) filter ({CARD}) from part)""",
    "ingest_run": f"""select case when {NAMED} then {NAME} else p_name end as name, {PRODUCT_URL} as product_url,
 case when {NAMED} then {PRODUCT_URL} else '{SITE}/en/list/' || ({K} // 10) end as source_page_url,
 case when {NAMED} then p_type || ' size ' || p_size || ' cm' else 'listed ' || p_type end as description,
 case when {NAMED} then cast({DOSAGE} as double) end as dosage, case when {NAMED} then ({K} % 7 + 1) || ' years' end as aging,
 case when {NAMED} then 2 else 0 end as n_awards, true as has_house from part where {NAMED} or ({CARD})""",
    "run_errors": f"{PAGE_ERRORS}",
    "stream_run_errors": f"{PAGE_ERRORS}",
    "media_upsert": f"""with p as (select {K} as k, 'https://h/i/' || {K} || '.png' as url from part)
 select sha256(url) as id, url, case when k % 3 <> 1 then 'b' when k % 2 = 0 then 'c' else 'a' end as source_page_url,
 case when k % 3 <> 1 or k % 2 = 0 then 'r2' else 'r1' end as run_id from p""",
    "ingest_house": f"""with m as (select ({S} % 200 + 1800) || ' - Start' as y, s_name || ' opens' as e from supplier
 union select ({S} % 200 + 1810) || ' - Cellar', s_name || ' opens' from supplier where {S} % 2 = 0
 union select ({S} % 200 + 1820) || ' - Award', 'Medal ' || {S} from supplier where {S} % 3 = 0)
 select 'Example House' as name, '{SITE}/' as website_url, (select count(*) from m) as milestones, (select count(distinct s_name) + 1 from supplier) as members,
 'House of ' || arg_max(s_name, {S}) || ' since ' || (max({S}) % 200 + 1800) as description, '{SITE}/en/maison/famille/' || max({S}) as source_page_url from supplier""",
    "stream_ingest_run": f"select {PRODUCT_URL} as product_url, true as has_house from part where {NAMED} or ({CARD})",
    "stream_live_metrics": """select count(*) as total_requests, count(*) filter (event_type <> 'error') as success_requests,
 count(*) filter (event_type = 'error') as failed_requests, round(count(*) filter (event_type = 'error') / count(*), 6) as error_rate from events""",
}
