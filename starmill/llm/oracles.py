"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

# A-Z in lower case; lower() would also change other letters
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = f"""
with recursive
words as (
  select doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\\x20\\x09-\\x0D]+') as w from documents
),
shingles as (
  select distinct doc_id, unnest(
    case when len(w) = 0 then []
         when len(w) < 4 then [array_to_string(w, ' ')]
         else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as s
  from words
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
sets as (select doc_id, n, list(s order by s) as s from shingles join sizes using (doc_id) group by doc_id, n),
classes as (select min(doc_id) as class_id, any_value(n) as n, s from sets group by s),
member as (select sets.doc_id, classes.class_id, sets.n from sets join classes on sets.s = classes.s),
flat as (select class_id, n, unnest(s) as s from classes),
pairs as (
  select a.class_id as x, b.class_id as y
  from flat a join flat b on a.s = b.s and a.class_id < b.class_id
  group by a.class_id, b.class_id, a.n, b.n
  having 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
edges as (select x, y from pairs union all select y, x from pairs),
reach as (
  select class_id as x, class_id as y from classes
  union
  select reach.x, edges.y from reach join edges on reach.y = edges.x
),
roots as (select x as class_id, min(y) as root from reach group by x)
select d.doc_id, coalesce(m.n, 0)::bigint as n_shingles, coalesce(r.root, d.doc_id) as component_id,
       d.doc_id = coalesce(r.root, d.doc_id) as kept
from documents d left join member m using (doc_id) left join roots r using (class_id)
"""

OP10 = r"""
with lines as (
  select rowid as row, source, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) as place
  from (select row_number() over () as rowid, * from documents)
),
keyed as (select *, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') as k from lines),
totals as (select source, count(*) as total from documents group by source having count(*) >= 10),
heavy as (
  select source, k from keyed join totals using (source) where k <> ''
  group by source, k, total having count(distinct row) > 1 and count(distinct row) / total > 0.1::double
),
kept as (
  select row, string_agg(line, chr(10) order by place) as text
  from keyed anti join heavy using (source, k) group by row
)
select doc_id, source, case when d.text is null then null else coalesce(kept.text, '') end as text
from (select row_number() over () as row, * from documents) d left join kept using (row)
"""

OP11 = f"""
with recursive
words as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(coalesce({_LOWER}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents
),
asked as (
  select item_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from benchmark
),
windows as (
  select distinct item_id, least(len(w), 10) as size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as phrase
  from (select item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) as i from asked where len(w) > 0)
),
sizes as (select distinct size from windows),
placed as (
  select r, size, i, array_to_string(w[i:i + size - 1], ' ') as phrase
  from (select r, w, size, unnest(range(1, len(w) - size + 2)) as i from words join sizes on len(w) >= size)
),
found as (select r, item_id, size, i from placed join windows using (size, phrase)),
hits as (
  select r, count(distinct k) as n_hit
  from (select r, unnest(range(i, i + size)) as k from (select distinct r, size, i from found)) group by r
),
named as (
  select r, count(*) as n_items, array_to_string(list(name order by name), ',') as names
  from (select distinct r, item_id::varchar as name from found where item_id is not null) group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(names, '')) as items_sha256, n_hit is not null as contaminated
from words left join hits using (r) left join named using (r)
"""

OP12 = f"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents where text is not null
),
words as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces),
placed as (select lang, w, unnest(range(1, len(w) + 1)) as i from words where len(w) > 0),
runs as (
  select lang, w[i] as w1, case when k > 1 then w[i + 1] end as w2, case when k > 2 then w[i + 2] end as w3, k
  from placed, (values (1), (2), (3)) as sizes(k) where i + k - 1 <= len(w)
),
f as (select lang, k, w1, w2, w3, count(*)::hugeint as a from runs group by all),
one as (select lang, w1 as w, a from f where k = 1),
two as (select * from f where k = 2),
totals as (select lang, sum(a)::bigint as n from one group by lang),
cuts as (
  select t.lang, t.w1 || ' ' || t.w2 as phrase, t.w1, t.w2, null as w3, t.a, 1 as cut, x.a as l, y.a as r
  from two t join one x on x.lang = t.lang and x.w = t.w1 join one y on y.lang = t.lang and y.w = t.w2
  where t.a >= 10
  union all
  select t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.w1, t.w2, t.w3, t.a, 1, x.a, y.a
  from f t join one x on x.lang = t.lang and x.w = t.w1 join two y on y.lang = t.lang and y.w1 = t.w2 and y.w2 = t.w3
  where t.k = 3 and t.a >= 10
  union all
  select t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.w1, t.w2, t.w3, t.a, 2, x.a, y.a
  from f t join two x on x.lang = t.lang and x.w1 = t.w1 and x.w2 = t.w2 join one y on y.lang = t.lang and y.w = t.w3
  where t.k = 3 and t.a >= 10
),
scored as (select *, 1000000::hugeint * a * a // (l * r) as score from cuts),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
around as (
  select lang, p1, p2, max(a) as a from (
    select lang, w1 as p1, w2 as p2, a from f where k = 3 and a >= 10
    union all select lang, w2, w3, a from f where k = 3 and a >= 10) group by all
),
left_over as (
  select b.* from best b left join around x on x.lang = b.lang and x.p1 = b.w1 and x.p2 = b.w2 and b.w3 is null
  where x.a is null or 100 * x.a < 50 * b.a
)
select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score::bigint as score
from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from left_over)
join totals using (lang) where rank <= 2000
"""

OP13 = f"""
with terms as (
  select row_number() over () as r, doc_id,
         regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as t
  from documents where text is not null
),
asked as (
  select distinct i, item_id, unnest(t) as term from (
    select row_number() over () as i, item_id,
           regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as t
    from benchmark where text is not null)
),
totals as (select count(*) as docs, sum(len(t))::bigint as total from terms where len(t) > 0),
postings as (select r, term, count(*) as tf from (select r, unnest(t) as term from terms) group by all),
weights as (
  select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)))::bigint as w
  from postings, totals group by term
),
scored as (
  select i, item_id, doc_id, r,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * len(t) * docs) // total)))))::bigint as score
  from asked join postings using (term) join weights using (term) join terms using (r), totals
  group by all
)
select item_id, rank::int as rank, doc_id, score
from (select *, row_number() over (partition by i order by score desc, doc_id nulls first) as rank from scored where score > 0)
where rank <= 50
"""

ORACLES = {"op4_minhash": OP4, "op10_line_dedup": OP10, "op11_decontaminate": OP11, "op12_collocations": OP12, "op13_search": OP13}
