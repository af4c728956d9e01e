"""DuckDB SQL of the queries that SQL can express, over whole tables and whole texts."""

WORDS = "list_filter(regexp_split_to_array({text}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

OP3 = f"""
with d as (select doc_id, {WORDS.format(text="coalesce(text, '')")} as w from documents),
n as (select doc_id, w, len(w) as n from d),
starts as (select doc_id, w, unnest(range(1, n - 11)) as s from n where n >= 13),
windows as (select doc_id, s, array_to_string(w[s:s + 12], ' ') as k from starts),
least as (select k, min(doc_id) as m from windows group by k),
gone as (select distinct doc_id, unnest(range(s, s + 13)) as p from windows join least using (k) where m < doc_id),
words as (select doc_id, unnest(w) as x, generate_subscripts(w, 1) as p from n where n > 0)
select n.doc_id, cast(n.n as bigint) as n_words, cast(count(gone.p) as bigint) as n_removed,
sha256(coalesce(string_agg(x, ' ' order by words.p) filter (where gone.p is null), '')) as kept_sha256
from n left join words using (doc_id) left join gone on gone.doc_id = n.doc_id and gone.p = words.p group by n.doc_id, n.n
"""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP8 = f"""
with recursive d as (select doc_id, {WORDS.format(text=LOWER)} as w from documents),
sets as (select doc_id, case when len(w) >= 3 then list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))
when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from d),
grams as (select doc_id, len(s) as n, unnest(s) as g from sets),
pairs as (select a.doc_id as x, b.doc_id as y, any_value(a.n) as m, any_value(b.n) as n, count(*) as o from grams a join grams b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
links as (select x, y from pairs where 100 * o >= 90 * (m + n - o)),
ways as (select x, y from links union all select y, x from links),
reach as (select x as node, y as seen from ways union select reach.node, ways.y from reach join ways on reach.seen = ways.x)
select doc_id, cast(len(s) as bigint) as n_shingles, least(doc_id, coalesce(m, doc_id)) as component_id, coalesce(c.n, 0) as n_links
from sets left join (select node, min(seen) as m from reach group by node) r on r.node = doc_id
left join (select x, count(*) as n from ways group by x) c on c.x = doc_id
"""

OP9 = """
with d as (select doc_id, hex(coalesce(text, '')) as h from documents),
places as (select doc_id, h, unnest(range(0, len(h) // 2 - 99)) as a from d where len(h) >= 200),
strings as (select doc_id, a, md5(substr(h, 2 * a + 1, 200)) as k, cast(doc_id as hugeint) * 1000000000 + a as place from places),
least as (select k, min(place) as m from strings group by k),
gone as (select doc_id, a from strings join least using (k) where m < place),
runs as (select doc_id, a, case when a > lag(a) over (partition by doc_id order by a) + 100 or lag(a) over (partition by doc_id order by a) is null then 1 else 0 end as new from gone),
numbered as (select doc_id, a, sum(new) over (partition by doc_id order by a) as span from runs),
spans as (select doc_id, span, min(a) as x, max(a) + 100 as y from numbered group by 1, 2),
pieces as (select doc_id, x, y, coalesce(lag(y) over (partition by doc_id order by x), 0) as last, lead(y) over (partition by doc_id order by x) is null as final from spans),
kept as (select doc_id, count(*) as n, sum(y - x) as r, string_agg(substr(h, 2 * last + 1, 2 * (x - last)) || case when final then substr(h, 2 * y + 1) else '' end, '' order by x) as k from pieces join d using (doc_id) group by 1)
select d.doc_id, cast(len(h) // 2 as bigint) as n_bytes, cast(coalesce(r, 0) as bigint) as n_removed, cast(coalesce(n, 0) as bigint) as n_spans, sha256(unhex(coalesce(k, h))) as kept_sha256
from d left join kept using (doc_id)
"""

SQL = {"op9_suffix_array_dedup": OP9, "op3_substring_dedup": OP3, "op8_ngram_jaccard_join": OP8}
