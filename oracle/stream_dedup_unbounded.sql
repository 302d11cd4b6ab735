select transaction_id, account_id, product_id, branch_id, amount, currency, transaction_type, status,
       strftime(event_date, '%Y-%m-%d') as event_date, cast(floor(epoch(event_ts)) as bigint) as event_ts,
       strftime(ingest_date, '%Y-%m-%d') as ingest_date
from bank_transaction
qualify row_number() over (partition by transaction_id order by event_ts, account_id nulls first, product_id nulls first,
    branch_id nulls first, amount nulls first, currency nulls first, transaction_type nulls first, status nulls first,
    event_date, ingest_date) = 1
