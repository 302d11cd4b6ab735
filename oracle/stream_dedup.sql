select * from (
with recursive ranked as (
  select *, row_number() over (partition by transaction_id order by event_ts, account_id nulls first, product_id nulls first,
    branch_id nulls first, amount nulls first, currency nulls first, transaction_type nulls first, status nulls first,
    event_date, ingest_date) as rn
  from bank_transaction
), kept(transaction_id, rn, event_ts) as (
  select transaction_id, rn, event_ts from ranked where rn = 1
  union all
  select k.transaction_id, min(r.rn), min(r.event_ts) from kept k
  join ranked r on r.transaction_id = k.transaction_id and r.event_ts > k.event_ts + interval '3 days'
  group by k.transaction_id, k.rn
)
select r.transaction_id, r.account_id, r.product_id, r.branch_id, r.amount, r.currency, r.transaction_type, r.status,
       strftime(r.event_date, '%Y-%m-%d') as event_date, cast(floor(epoch(r.event_ts)) as bigint) as event_ts,
       strftime(r.ingest_date, '%Y-%m-%d') as ingest_date
from ranked r join kept k on k.transaction_id = r.transaction_id and k.rn = r.rn
) found
