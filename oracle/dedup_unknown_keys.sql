with missing as (
  select * replace (case when transaction_id % 7 = 0 then null else transaction_id end as transaction_id) from bank_transaction),
ranked as (
  select *, row_number() over (partition by transaction_id order by ingest_date desc, event_ts desc) as rn from missing)
select transaction_id, account_id, product_id, branch_id, amount, currency, transaction_type, status,
       strftime(event_date, '%Y-%m-%d') as event_date, cast(floor(epoch(event_ts)) as bigint) as event_ts,
       strftime(ingest_date, '%Y-%m-%d') as ingest_date
from ranked where rn = 1 or transaction_id is null
