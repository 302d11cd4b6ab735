with daily as (
  select account_id, event_date, sum(cast(amount as decimal(18,2))) as total from bank_transaction group by 1, 2
)
select account_id, strftime(event_date, '%Y-%m-%d') as event_date, cast(total as double) as daily_total,
       cast(sum(total) over (partition by account_id order by event_date) as double) as running_balance
from daily
