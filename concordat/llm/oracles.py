"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP6_SQL = """
with p as (select page_id, encode(coalesce(html, '')) as b, sha1(coalesce(html, '')) as d from pages),
g as (select d, max(page_id) as first from p where octet_length(b) >= 1000 group by d having count(*) > 1)
select p.page_id, cast(octet_length(b) as bigint) as payload_bytes, p.d as payload_digest,
       case when first is null or first = page_id then 'response' else 'revisit' end as record_type,
       case when first <> page_id then first end as refers_to
from p left join g on p.d = g.d
"""

OP10_SQL = """
with recursive v as (select vec_id, cast(embedding as double[]) as x from embeddings),
g as (select vec_id, x from v where vec_id is not null and len(x) > 0
      and len(list_filter(x, lambda e: e is null or not isfinite(e))) = 0 and len(list_filter(x, lambda e: e <> 0)) > 0),
l as (select a.vec_id as a, b.vec_id as b from g a join g b on a.vec_id <> b.vec_id and len(a.x) = len(b.x) where list_cosine_similarity(a.x, b.x) >= 0.95),
r(id, root) as (select distinct a, a from l union select l.b, r.root from r join l on l.a = r.id),
c as (select id, min(root) as root from r group by id),
n as (select a, count(*) as n from l group by a)
select v.vec_id, coalesce(n.n, 0) as n_links, coalesce(c.root, v.vec_id) as component_id, coalesce(c.root, v.vec_id) = v.vec_id as kept
from v left join n on n.a = v.vec_id left join c on c.id = v.vec_id
"""

WORDS_SQL = r"list_filter(string_split_regex({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP7_SQL = f"""
with d as (select doc_id, {WORDS_SQL.format("coalesce(text, '')")} as ws from documents),
win as (select doc_id, i, md5(array_to_string(ws[i : i + 49], ' ')) as h from (select doc_id, ws, unnest(range(1, len(ws) - 48)) as i from d)),
first as (select h, min(doc_id) as m from win group by h),
gone as (select distinct doc_id, unnest(range(i, i + 50)) as p from win join first using (h) where m < doc_id),
words as (select doc_id, unnest(ws) as w, generate_subscripts(ws, 1) as p from d),
kept as (select doc_id, count(*) as n, string_agg(w, ' ' order by p) as t from words anti join gone using (doc_id, p) group by doc_id)
select d.doc_id, cast(len(ws) as bigint) as n_words, cast(len(ws) - coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (doc_id)
"""

OP4_SQL = f"""
with recursive d as (select doc_id, {WORDS_SQL.format("lower(coalesce(text, ''))")} as ws from documents),
s as (select distinct doc_id, array_to_string(ws[i : i + 4], ' ') as g from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as i from d where len(ws) > 0)),
c as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by all),
l as (select a, b, k = x.n and k = y.n as same from p join c x on x.doc_id = a join c y on y.doc_id = b where k >= 0.8 * (x.n + y.n - k) - 1e-9),
r(id, root) as (select distinct a, a from l union select l.b, r.root from r join l on l.a = r.id),
m as (select id, min(root) as root from r group by id),
n as (select a, count(*) as n, min(b) filter (same) as same from l group by a)
select d.doc_id, least(d.doc_id, coalesce(n.same, d.doc_id)) as class_id, coalesce(n.n, 0) as n_links, coalesce(root, d.doc_id) as component_id, coalesce(root, d.doc_id) = d.doc_id as kept
from d left join n on n.a = d.doc_id left join m on m.id = d.doc_id
"""

ORACLE_SQL: dict[str, str] = {"op4_near_texts": OP4_SQL, "op6_warc": OP6_SQL, "op7_substrings": OP7_SQL, "op10_near_vectors": OP10_SQL}
