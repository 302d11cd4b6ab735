with timed as (
  select transaction_id, account_id, cast(floor(epoch(event_ts)) as bigint) as event_ts, amount
  from bank_transaction where status = 'Approved'
), counted as (
  select *, count(*) over (partition by account_id order by event_ts
    range between 120 preceding and 120 following) as velocity_count
  from timed
)
select transaction_id, account_id, event_ts, amount, velocity_count, true as is_velocity_alert
from counted where velocity_count >= 5
