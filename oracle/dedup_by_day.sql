with ranked as (
  select *, row_number() over (partition by transaction_id, event_date order by ingest_date desc, event_ts desc) as rn
  from bank_transaction
)
select transaction_id, account_id, product_id, branch_id, amount, currency, transaction_type, status,
       strftime(event_date, '%Y-%m-%d') as event_date, cast(floor(epoch(event_ts)) as bigint) as event_ts,
       strftime(ingest_date, '%Y-%m-%d') as ingest_date
from ranked where rn = 1
