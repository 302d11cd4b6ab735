select transaction_id, account_id, product_id, branch_id, amount, currency, transaction_type, status,
       strftime(event_date, '%Y-%m-%d') as event_date, cast(floor(epoch(event_ts)) as bigint) as event_ts,
       strftime(ingest_date, '%Y-%m-%d') as ingest_date
from bank_transaction
where transaction_id is null or account_id is null or account_id <= 0
  or amount is null or amount = -999999.99 or currency is null or currency = 'XXX'
  or event_date is null or transaction_type is null or transaction_type = 'UNKNOWN'
