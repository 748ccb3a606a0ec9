"""SQL that gives the rows of the queries that SQL can express."""

SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
with recursive w as (select doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') as ws from documents),
s as (select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 3 then [array_to_string(ws, ' ')]
        else list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) end) as g from w),
n as (select doc_id, count(*) as n from s group by 1),
p as (select a.doc_id as a, b.doc_id as b, count(*) as o from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
l as (select p.a, p.b from p join n x on x.doc_id = p.a join n y on y.doc_id = p.b where 100 * o >= 90 * (x.n + y.n - o)),
e as (select a, b from l union all select b, a from l),
r(a, b) as (select doc_id, doc_id from documents union select r.a, e.b from r join e on r.b = e.a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, (select min(b) from r where r.a = d.doc_id) as component_id from documents d left join n on n.doc_id = d.doc_id
"""

OP3 = rf"""
with w as (select doc_id, {SPACED} as ws from documents),
win as (select doc_id, i, array_to_string(ws[i : i + 34], ' ') as t from (select doc_id, ws, unnest(range(1, len(ws) - 33)) as i from w)),
dup as (select t from win group by t having count(*) > 1),
hit as (select distinct doc_id, unnest(range(i, i + 35)) as i from win where t in (select t from dup)),
words as (select doc_id, unnest(ws) as x, generate_subscripts(ws, 1) as i from w),
kept as (select words.doc_id, string_agg(x, ' ' order by words.i) as k from words left join hit on words.doc_id = hit.doc_id and words.i = hit.i where hit.i is null group by 1)
select w.doc_id, len(ws) as n_words, coalesce((select count(*) from hit where hit.doc_id = w.doc_id), 0) as n_removed, sha256(coalesce(k, '')) as kept_sha256
from w left join kept on kept.doc_id = w.doc_id
"""

OP4 = """
with d as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as h from pages),
r as (select *, max(page_id) over (partition by h) as lead from d)
select page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((('0x' || substr(h, 5 * (j // 4) + 1, 5))::int >> (15 - 5 * (j % 4))::int)) & 31), 1)), '') as payload_digest,
  case when page_id = lead then 'response' else 'revisit' end as record_type, case when page_id <> lead then lead end as refers_to from r
"""

# CRC-32 goes byte by byte with a table made from its polynomial (0xEDB88320).
OP5 = """
with recursive bits(b, k, v) as (select range, 0, range from range(256) union all select b, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from bits where k < 8),
steps as (select list(v order by b) as t from bits where k = 8),
c as (select doc_id, strlen(coalesce(text, '')) + 1 as size, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::bigint),
        lambda a, x: xor(a >> 8, t[1 + xor(a & 255, x)]), 4294967295), 4294967295) as text_crc32 from documents, steps),
p as (select *, row_number() over o as nth, sum(size) over (o rows unbounded preceding) as upto, sum(size) over () as total from c window o as (order by doc_id nulls first, text_crc32, size)),
s as (select *, cast(least(15, (2 * upto - size) * 16 // (2 * total)) as int) as shard from p)
select doc_id, cast(size as bigint) as size, text_crc32, 'bytes' as law, shard, nth - min(nth) over (partition by shard) as slot, cast(null as int) as grown_shard from s
"""

OP7 = r"""
with p as (select doc_id, text, regexp_extract(coalesce(text, ''), '^[\n\r]*') as head, regexp_extract_all(coalesce(text, ''), '[^\n\r]+[\n\r]*') as ps from documents),
l as (select doc_id, unnest(ps) as piece, generate_subscripts(ps, 1) as i from p),
s as (select *, rtrim(piece, chr(10) || chr(13)) as line, row_number() over (partition by doc_id order by i) as k from l where regexp_matches(piece, '[^\x20\x09-\x0D]')),
runs as (select a.doc_id, a.k, a.line as x, b.line as y from s a join s b on a.doc_id = b.doc_id and b.k = a.k + 1),
f as (select *, row_number() over (partition by x, y order by doc_id, k) as nth from runs),
long as (select doc_id, k, row_number() over (partition by line order by doc_id, k) as nth from s where len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 50),
gone as (select doc_id, unnest([k, k + 1]) as k from f where nth > 1 union select doc_id, k from long where nth > 1),
cut as (select s.doc_id, s.i from s join gone on gone.doc_id = s.doc_id and gone.k = s.k),
kept as (select l.doc_id, string_agg(piece, '' order by l.i) as t from l left join cut on cut.doc_id = l.doc_id and cut.i = l.i where cut.i is null group by 1)
select p.doc_id, cast((select count(*) from s where s.doc_id = p.doc_id) as int) as n_lines, cast((select count(*) from cut where cut.doc_id = p.doc_id) as int) as n_removed,
  sha256(head || coalesce(t, '')) as kept_sha256 from p left join kept on kept.doc_id = p.doc_id
"""

OP8 = rf"""
with d as (select doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
b as (select item_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
q as (select distinct item_id, least(len(ws), 10) as m, array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') as t
      from (select item_id, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) as i from b where len(ws) > 0)),
win as (select doc_id, i, m, array_to_string(ws[i : i + m - 1], ' ') as t from (select doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) as i from d, (select distinct m from q) where len(ws) >= m)),
found as (select win.doc_id, win.i, win.m, q.item_id from win join q on win.t = q.t and win.m = q.m),
hit as (select doc_id, count(*) as n from (select distinct doc_id, unnest(range(i, i + m)) as i from found) group by 1),
its as (select doc_id, count(*) as n, string_agg(id, ',' order by id) as ids from (select distinct doc_id, cast(item_id as varchar) as id from found where item_id is not null) group by 1)
select d.doc_id, len(ws) as n_words, coalesce(hit.n, 0) as n_hit, coalesce(its.n, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(hit.n, 0) > 0 as contaminated
from d left join hit on hit.doc_id = d.doc_id left join its on its.doc_id = d.doc_id
"""

OP12 = rf"""
with d as (select doc_id, row_number() over () as row, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
n as (select row, doc_id, len(ws) as n from d where len(ws) > 0),
s as (select count(*) as docs, sum(n)::bigint as words from n),
tf as (select row, term, count(*) as tf from (select row, unnest(ws) as term from d) group by all),
w as (select term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::bigint as w from (select term, count(*) as df from tf group by 1), s),
q as (select item, item_id, term, count(*) as c from (select row_number() over () as item, item_id, unnest(regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as term from benchmark) group by all),
x as (select item, item_id, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // words))))::bigint as score
      from q join w using (term) join tf using (term) join n using (row), s group by item, item_id, row, doc_id),
r as (select *, row_number() over (partition by item order by score desc, doc_id nulls last)::int as rank from x where score > 0)
select item_id, rank, doc_id, score from r where rank <= 20
"""

# Each order is walked step by step over the documents' failures, and the sums over all orders are taken from these steps.
OP13 = rf"""
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, {SPACED} as ws from documents),
m as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by 1),
f as (select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic, (case when len(ws) < 100 then 'A' else '' end) || (case when 100 * len(list_distinct(ws)) < 80 * len(ws) then 'B' else '' end)
        || (case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) then 'C' else '' end) || (case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end)
        || (case when d.doc_id > min(d.doc_id) over (partition by t) then 'E' else '' end) as fails from d left join m on m.doc_id = d.doc_id),
g as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from f group by all),
l as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
o as (select a.x || b.x || c.x || d.x || e.x as filter_order from l a, l b, l c, l d, l e where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s as (select filter_order, step::int as step, filter_order[step] as own, filter_order[1 : step - 1] as before from o, range(1, 6) r(step)),
w as (select g.*, filter_order, step, own, contains(fails, own) as hit, len(list_intersect(string_split(before, ''), string_split(fails, ''))) > 0 and before <> '' and fails <> '' as gone from g, s),
r as (select part, filter_order, step, own, sum(n) filter (not gone and not hit) as kept, sum(n) filter (hit and not gone) as removed, sum(n) filter (hit and gone) as redundant, sum(n) filter (fails = own) as unique_fails,
        sum(good) filter (hit and not gone) as good_lost, sum(toxic) filter (hit and not gone) as toxic_lost from w group by all)
select part, filter_order, step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed, coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails,
  coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost, coalesce(sum(removed) over (partition by part, own), 0)::bigint as shapley from r
"""
