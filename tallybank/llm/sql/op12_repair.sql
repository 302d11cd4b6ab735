with recursive crc_step(b, c, k) as (
  select b, b, 0 from range(256) r(b)
  union all
  select b, xor(c >> 1, 3988292384 * (c & 1)), k + 1 from crc_step where k < 8),
crc_table as (select list(c order by b) as t from crc_step where k = 8),
given as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         xor(4294967295, list_reduce(
           list_prepend(4294967295::bigint, list_transform(
             string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''),
             lambda x: cast(ord(x) as bigint))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 as kind
  from conversations, crc_table),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
         case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from given, range(2) r(again) where kind <> 0 and (again = 0 or kind = 3)),
ordered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos,
         count(*) over (partition by conv_id) as n
  from damaged),
placed as (
  select *, row_number() over (partition by conv_id, role, text order by pos) > 1 as repeated,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) as ending, substr(role, 1, 1) as initial
  from ordered),
judged as (
  select *, case when ending = '' then 'b' when repeated then 'd' when ending in ('.', '!', '?') then '' else 't' end as fault,
         lag(initial) over (partition by conv_id order by pos) as before
  from placed),
counted as (
  select conv_id, any_value(n) as n, count(*) filter (where fault = 'b') as blank, count(*) filter (where fault = 'd') as duplicate,
         count(*) filter (where fault = 't') as truncated,
         count(*) filter (where pos > 1 and before || initial not in ('su', 'ua', 'au')) as illegal,
         coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps
  from judged group by conv_id),
state(st, next, label) as (values (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
legal(st, initial, next) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
inserted(st, dest, more, letters, body) as (
  select st, st, 0, '', '' from state
  union all select st, next, 5, 'I', chr(10) || label || ':' from state
  union all select a.st, b.next, 10, 'II', chr(10) || a.label || ':' || chr(10) || b.label || ':'
  from state a join state b on b.st = a.next),
moves as (
  select j.conv_id, j.pos, s.st, s.st as dest, 2 as more, 'D' as letter, '' as body from judged j, state s
  union all
  select j.conv_id, j.pos, l.st, l.next, case when fault = 't' then 5 else 0 end, 'K', chr(10) || role || ':' || text
  from judged j join legal l on l.initial = j.initial where fault not in ('b', 'd')
  union all
  select j.conv_id, j.pos, s.st, s.next, case when fault = 't' then 6 else 1 end, 'R', chr(10) || s.label || ':' || text
  from judged j, state s where fault not in ('b', 'd')),
ways(conv_id, pos, st, way) as (
  select conv_id, cast(0 as bigint), 0, {'cost': 0, 'audit': '', 'body': ''} from counted
  union all
  select w.conv_id, w.pos + 1, m.dest,
         min({'cost': w.way.cost + i.more + m.more, 'audit': w.way.audit || i.letters || m.letter,
              'body': w.way.body || i.body || m.body})
  from ways w join inserted i on i.st = w.st
  join moves m on m.conv_id is not distinct from w.conv_id and m.pos = w.pos + 1 and m.st = i.dest
  group by w.conv_id, w.pos + 1, m.dest),
best as (
  select w.conv_id, min({'cost': w.way.cost + i.more, 'audit': w.way.audit || i.letters, 'body': w.way.body || i.body}) as way
  from ways w join counted c on c.conv_id is not distinct from w.conv_id and c.n = w.pos
  join inserted i on i.st = w.st where i.dest in (0, 3) group by w.conv_id)
select g.conv_id, coalesce(c.gaps, 0) as gaps, coalesce(c.blank, 0) as blank, coalesce(c.duplicate, 0) as duplicate,
       coalesce(c.truncated, 0) as truncated, coalesce(c.illegal, 0) as illegal, cast(coalesce(b.way.cost, 0) as bigint) as cost,
       coalesce(b.way.audit, '') as audit, sha256(substr(coalesce(b.way.body, ''), 2)) as repaired_sha256
from (select distinct conv_id from conversations) g
left join counted c on c.conv_id is not distinct from g.conv_id
left join best b on b.conv_id is not distinct from g.conv_id
