with feed as (
  select case when customer_id > 0 then customer_id end as customer_id,
         case when account_type is not null then open_date + 60 end as day,
         case when balance < 0 then 'High' when balance < 5000 then 'Medium' else 'Low' end as tier, count(*) as copies
  from bank_account group by 1, 2, 3
), opened as (
  select * from bank_customer_scd2 where is_current
), last as (
  select f.customer_id, f.day, max(f.tier) as tier, any_value(o.effective_start) as start, any_value(o.risk_tier) as old_tier
  from feed f left join opened o on o.customer_id = f.customer_id
  where f.customer_id is not null and f.day is not null group by 1, 2
), chained as (
  select *, coalesce(lag(tier) over (partition by customer_id, coalesce(day < start, false) order by day), old_tier) as before
  from last
), judged as (
  select f.*, case when f.customer_id is null then 'unknown key' when f.day is null then 'unknown date'
                   when f.tier <> c.tier then 'superseded' when f.day < c.start then 'stale'
                   when f.tier = c.before then 'unchanged' else 'applied' end as outcome
  from feed f left join chained c on c.customer_id = f.customer_id and c.day = f.day
)
select customer_id, strftime(day, '%Y-%m-%d') as change_date, tier as risk_tier, copies, outcome,
       case when day >= date '2023-12-15' then 'late' else 'early' end as feed
from judged where outcome <> 'applied'
