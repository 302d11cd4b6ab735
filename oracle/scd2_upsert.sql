with feed as (
  select customer_id, open_date + 60 as day,
         max(case when balance < 0 then 'High' when balance < 5000 then 'Medium' else 'Low' end) as tier
  from bank_account where customer_id > 0 and account_type is not null group by 1, 2
), opened as (
  select * from bank_customer_scd2 where is_current
), steps as (
  select o.customer_id, o.first_name, o.version as base, o.effective_start as day, coalesce(f.tier, o.risk_tier) as tier
  from opened o left join feed f on f.customer_id = o.customer_id and f.day = o.effective_start
  union all
  select f.customer_id, o.first_name, coalesce(o.version, 1), f.day, f.tier
  from feed f left join opened o on o.customer_id = f.customer_id
  where o.customer_id is null or f.day > o.effective_start
), compared as (
  select *, lag(tier) over (partition by customer_id order by day) as previous from steps
), kept as (
  select * from compared where previous is null or previous <> tier
), chained as (
  select *, lead(day) over (partition by customer_id order by day) as next_day,
         row_number() over (partition by customer_id order by day) as pos
  from kept
)
select customer_id, first_name, risk_tier, strftime(effective_start, '%Y-%m-%d') as effective_start,
       strftime(effective_end, '%Y-%m-%d') as effective_end, is_current, version
from bank_customer_scd2 where not is_current
union all
select customer_id, first_name, tier, strftime(day, '%Y-%m-%d'), strftime(next_day - 1, '%Y-%m-%d'),
       next_day is null, cast(base + pos - 1 as int)
from chained
