with recursive words as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
sets as (
  select doc_id, list_distinct(case when len(w) is null or len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
  from words),
sizes as (select doc_id, len(s) as n from sets),
tokens as (select doc_id, unnest(s) as t from sets),
hashed as (select doc_id, md5_number(t) as t from tokens),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as common
  from hashed a join hashed b on a.t = b.t and a.doc_id < b.doc_id group by 1, 2),
links as (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * common >= 80 * (x.n + y.n - common)),
both_ways as (select a, b from links union all select b, a from links),
reach(node, root) as (
  select doc_id, doc_id from sizes
  union
  select l.b, r.root from reach r join both_ways l on l.a = r.node where r.root < l.b)
select s.doc_id, cast(s.n as bigint) as n_shingles, min(r.root) as component_id
from sizes s join reach r on r.node = s.doc_id group by s.doc_id, s.n
