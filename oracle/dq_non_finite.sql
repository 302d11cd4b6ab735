select transaction_id, account_id, product_id, branch_id, amount, currency, transaction_type, status,
       strftime(event_date, '%Y-%m-%d') as event_date, cast(floor(epoch(event_ts)) as bigint) as event_ts,
       strftime(ingest_date, '%Y-%m-%d') as ingest_date
from bank_transaction
where transaction_id is not null and account_id is not null and account_id > 0
  and amount is not null and amount <> -999999.99 and currency is not null and currency <> 'XXX'
  and event_date is not null and transaction_type is not null and transaction_type <> 'UNKNOWN'
  and transaction_id % 11 <> 0 and transaction_id % 13 <> 0
