"""DuckDB SQL for those queries that SQL can express."""

OP1 = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), s as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)] end) as g
  from w
), n as (select doc_id, count(*) as n from s group by doc_id
), sets as (select md5(string_agg(g, chr(10) order by g)) as h, doc_id from s group by doc_id
), classes as (select h, min(doc_id) as c from sets group by h
), own as (select sets.doc_id, c from sets join classes using (h)
), t as (select g, doc_id from s where doc_id in (select c from classes)
), i as (
  select a.doc_id as x, b.doc_id as y, count(*) as k from t a join t b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2
), l as (
  select x, y from i join n p on p.doc_id = x join n q on q.doc_id = y where 100 * k >= 85 * (p.n + q.n - k)
), e as (select x, y from l union all select y, x from l
), r as (
  select c as x, c as y from classes
  union
  select r.x, e.y from r join e on r.y = e.x
), m as (select x, min(y) as m from r group by x)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(m.m, d.doc_id) as component_id, d.doc_id = coalesce(m.m, d.doc_id) as kept
from documents d left join n using (doc_id) left join own using (doc_id) left join m on m.x = own.c
"""

OP2 = r"""
with w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), p as (
  select doc_id, i, array_to_string(w[i:i + 34], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 33)) as i from w where len(w) >= 35)
), r as (select doc_id, i from (select doc_id, i, count(*) over (partition by g) as n from p) where n > 1
), x as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as j from w
), c as (
  select x.doc_id, x.j, x.word, max(r.i) over (partition by x.doc_id order by x.j) as latest
  from x left join r on r.doc_id = x.doc_id and r.i = x.j
), k as (
  select doc_id, count(*) as n, count(*) filter (latest is not null and latest > j - 35) as m,
         string_agg(word, ' ' order by j) filter (latest is null or latest <= j - 35) as kept
  from c group by doc_id
)
select d.doc_id, coalesce(n, 0)::bigint as n_words, coalesce(m, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from documents d left join k using (doc_id)
"""

OP3 = """
with recursive v as (
  select vec_id, label, embedding::double[64] as e from embeddings
  where label is not null and embedding is not null and list_sum([x * x for x in embedding]) > 0
), l as (
  select a.vec_id as x, b.vec_id as y from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where array_cosine_similarity(a.e, b.e) >= 0.98
), r as (
  select vec_id as x, vec_id as y from embeddings
  union
  select r.x, l.y from r join l on r.y = l.x
), c as (select x, min(y) as component_id from r group by x), n as (select x, count(*) as n from l group by x)
select d.vec_id, coalesce(n.n, 0)::bigint as n_links, c.component_id, d.vec_id = c.component_id as kept
from embeddings d join c on d.vec_id = c.x left join n on n.x = d.vec_id
"""

OP9 = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         ('0x' || substr(md5(doc_id::varchar), 1, 15))::bigint as place
  from documents
), s as (
  select source, sum(size)::bigint as source_size, (row_number() over (order by source asc nulls last) - 1) % 3 as k,
         row_number() over (order by source asc nulls last) as num
  from d group by source
), w as (
  select *, (case k when 0 then 3.0 when 1 then 1.0 else 2.0 end)::double as weight, (2 * source_size)::double as bound from s
), l as (
  select *, coalesce(sum(bound) over (order by bound / weight, num rows between unbounded preceding and 1 preceding), 0) as filled,
         sum(weight) over (order by bound / weight, num rows between current row and unbounded following) as left_weight,
         sum(source_size) over () * 1.5::double as wanted
  from w
), o as (
  select *, (wanted - filled) / left_weight as level from l
), t as (
  select *, (select arg_min(level, (bound / weight, num)) from o where level * weight <= bound) as open from o
), g as (
  select source, source_size, case when open is null then bound else least(open * weight, bound) end as target,
         ramp
  from (select *, (case (num - 1) % 3 when 0 then 0.5 when 1 then 0.0 else -0.5 end)::double as ramp from t)
), p as (
  select d.doc_id, d.size, g.source_size, g.target, g.ramp,
         coalesce(sum(d.size) over (partition by d.source order by d.place, d.doc_id rows between unbounded preceding and 1 preceding), 0) as before
  from d join g on d.source is not distinct from g.source
), q as (
  select *, greatest(0, least(size, round(target)::bigint - before))::bigint as took0,
         greatest(0, least(size, round(target)::bigint - before - source_size))::bigint as took1,
         case when target > 0 then before::double / target else 0.0 end as share
  from p
)
select doc_id, size, source_size, target, took0 + took1 as taken,
       case when took0 > 0 then case when ramp = 0 then share
         else 2 * share / (1 + ramp + sqrt(greatest((1 + ramp) * (1 + ramp) - 4 * ramp * share, 0))) end end as position
from q
"""

ORACLES = {"op1_minhash": OP1, "op2_substrings": OP2, "op3_embeddings": OP3, "op9_mixing": OP9}
