with valid as (
  select transaction_id, account_id, cast(floor(epoch(event_ts)) as bigint) as event_ts, amount,
         cast(floor(epoch(event_date)) as bigint) - 6 * 86400 as window_start
  from bank_transaction
  where account_id > 0 and amount <> -999999.99
), cumulated as (
  select *, sum(cast(amount as decimal(18,2))) over w as sum_before, count(*) over w as rows_before,
         row_number() over (partition by account_id order by event_ts, transaction_id) as pos
  from valid
  window w as (partition by account_id order by event_ts range between unbounded preceding and 1 preceding)
), bounds as (
  select account_id, window_start, max(cum_sum) as sum_outside, max(cum_rows) as rows_outside
  from (
    select d.account_id, d.window_start, sum(v.daily_sum) as cum_sum, sum(v.daily_rows) as cum_rows
    from (select distinct account_id, window_start from valid) d
    join (select account_id, event_ts - event_ts % 86400 as day_start, sum(cast(amount as decimal(18,2))) as daily_sum,
                 count(*) as daily_rows
          from valid group by 1, 2) v
      on v.account_id = d.account_id and v.day_start < d.window_start
    group by 1, 2
  ) x group by 1, 2
), based as (
  select c.transaction_id, c.account_id, c.event_ts, c.amount,
         coalesce(c.sum_before, 0) - coalesce(b.sum_outside, 0) as base_sum,
         c.rows_before - coalesce(b.rows_outside, 0) as base_rows
  from cumulated c left join bounds b on b.account_id = c.account_id and b.window_start = c.window_start
)
select transaction_id, account_id, event_ts, amount, cast(base_sum as double) / cast(base_rows as bigint) as baseline_avg
from based
where base_rows > 0 and amount > 3.0 * (cast(base_sum as double) / cast(base_rows as bigint))
