with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
         coalesce(cast('0x' || substr(md5(cast(doc_id as varchar)), 1, 15) as bigint), -1) as k
  from documents),
sources as (
  select source, sum(size) as source_size, row_number() over (order by source nulls last) as sid from sized group by source),
weighed as (
  select *, case (sid - 1) % 3 when 0 then 3 when 1 then 1 else 2 end as weight, 2 * source_size as lim from sources),
filled as (
  select *, sum(lim) over w as lims, sum(weight) over w as ws from weighed
  window w as (order by lim / weight, sid rows unbounded preceding)),
whole as (select 1.5 * sum(source_size) as budget, sum(weight) as weight from weighed),
marked as (
  select f.*, f.lim * (t.weight - ws + f.weight) <= f.weight * (budget - lims + lim) as full_up, budget, t.weight as all_weight
  from filled f, whole t),
rest as (
  select (cast(any_value(budget) as double) - coalesce(sum(lim) filter (where full_up), 0)::double)
         / (any_value(all_weight) - coalesce(sum(weight) filter (where full_up), 0)) as level from marked),
targets as (
  select source, sid, source_size, weight, budget, case when full_up then cast(lim as double) else weight * level end as target
  from marked, rest),
queued as (
  select d.doc_id, d.size, d.k, t.sid, t.source_size, t.weight, t.target, t.budget,
         sum(d.size) over (partition by t.sid order by d.k, d.doc_id, d.size rows unbounded preceding) as reached
  from sized d join targets t on d.source is not distinct from t.source),
items as (
  select *, cast(turn * source_size + reached as double) / weight as finish
  from queued, (values (0), (1)) v(turn) where size > 0),
ordered as (
  select doc_id, size, budget, sum(size) over (order by finish, sid, k, doc_id, size rows unbounded preceding) as total from items),
taken as (select doc_id, sum(size) as taken from ordered where total <= budget group by doc_id)
select q.doc_id, cast(q.size as bigint) as size, cast(q.source_size as bigint) as source_size, q.target,
       cast(coalesce(t.taken, 0) as bigint) as taken
from queued q left join taken t on q.doc_id = t.doc_id
