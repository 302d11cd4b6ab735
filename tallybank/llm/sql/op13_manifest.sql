with recursive crc_step(b, c, k) as (
  select b, b, 0 from range(256) r(b)
  union all
  select b, xor(c >> 1, 3988292384 * (c & 1)), k + 1 from crc_step where k < 8),
crc_table as (select list(c order by b) as t from crc_step where k = 8),
rows as (
  select doc_id, source, text, lang, n_chars,
         row_number() over () as id,
         coalesce(xor(4294967295, list_reduce(
           list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ord(x) as bigint))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 2 = 0, false) as tampered
  from documents, crc_table),
fields as (
  select id, doc_id, source, tampered,
         coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') as head,
         coalesce(strlen(text) || ':' || text, '-') as body,
         coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-') as cut
  from rows),
leaves as (
  select id, doc_id, source, sha256(head || body) as leaf,
         case when tampered then sha256(head || cut) else sha256(head || body) end as offered
  from fields),
ranked as (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as rank,
         count(*) over (partition by source) as n
  from leaves),
nodes(source, height, idx, n, digest) as (
  select source, 0, rank, n, leaf from ranked
  union all
  select source, height + 1, idx // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' order by idx))
  from nodes where n > 1 group by source, height, idx // 3),
subroots as (
  select source, height, digest as subroot, row_number() over (order by source nulls first) - 1 as rank, count(*) over () as n
  from nodes where n = 1),
tops(height, idx, n, digest) as (
  select 0, rank, n, subroot from subroots
  union all
  select height + 1, idx // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' order by idx))
  from tops where n > 1 group by height, idx // 3),
root as (select digest as root from tops where n = 1),
steps as (
  select r.id, p.height as step, r.rank // cast(3 ** p.height as bigint) as idx, false as upper
  from ranked r join subroots s on s.source is not distinct from r.source, range(0, s.height) p(height)
  union all
  select r.id, s.height + p.height, s.rank // cast(3 ** p.height as bigint), true
  from ranked r join subroots s on s.source is not distinct from r.source,
       range(0, (select max(height) from tops)) p(height)),
siblings as (
  select st.id, st.step,
         coalesce(string_agg(o.digest, '' order by o.idx) filter (where o.idx < st.idx), '') as before,
         coalesce(string_agg(o.digest, '' order by o.idx) filter (where o.idx > st.idx), '') as after
  from steps st join ranked r on r.id = st.id join subroots s on s.source is not distinct from r.source
  join (select source, height, idx, digest, false as upper from nodes
        union all select null, height, idx, digest, true from tops) o
    on o.upper = st.upper and o.height = case when st.upper then st.step - s.height else st.step end
   and o.idx // 3 = st.idx // 3 and (st.upper or o.source is not distinct from r.source)
  group by st.id, st.step),
paths as (
  select id, list({'before': before, 'after': after} order by step) as path, string_agg(before || after, '' order by step) as proof
  from siblings group by id),
folds(id, step, digest) as (
  select id, 0, offered from leaves
  union all
  select f.id, f.step + 1, sha256(p.path[f.step + 1].before || f.digest || p.path[f.step + 1].after)
  from folds f join paths p on p.id = f.id where f.step < len(p.path)),
ends as (select id, arg_max(digest, step) as folded_root from folds group by id)
select r.doc_id, r.leaf, s.subroot, root.root, sha256(coalesce(p.proof, '')) as proof_sha256, e.folded_root,
       e.folded_root = root.root as verified
from ranked r join subroots s on s.source is not distinct from r.source
left join paths p on p.id = r.id join ends e on e.id = r.id, root
