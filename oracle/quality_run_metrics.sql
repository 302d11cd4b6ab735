with counted as (
select 'failed_txn_id' as rule, count(*) as violations from bank_transaction where transaction_id is null
union all select 'failed_acct_id', count(*) from bank_transaction where account_id is null or account_id <= 0
union all select 'failed_amount', count(*) from bank_transaction where amount is null or amount = -999999.99
union all select 'failed_currency', count(*) from bank_transaction where currency is null or currency = 'XXX'
union all select 'failed_date', count(*) from bank_transaction where event_date is null
union all select 'failed_type', count(*) from bank_transaction where transaction_type is null or transaction_type = 'UNKNOWN'
union all select 'total', count(*) from bank_transaction
union all select 'valid', count(*) from bank_transaction where transaction_id is not null and account_id is not null and account_id > 0
  and amount is not null and amount <> -999999.99 and currency is not null and currency <> 'XXX'
  and event_date is not null and transaction_type is not null and transaction_type <> 'UNKNOWN'
union all select 'quarantined', count(*) from bank_transaction where not coalesce(transaction_id is not null and account_id is not null and account_id > 0
  and amount is not null and amount <> -999999.99 and currency is not null and currency <> 'XXX'
  and event_date is not null and transaction_type is not null and transaction_type <> 'UNKNOWN', false)
)
select rule as metric, violations as row_count, 100.0::double * violations / (select count(*) from bank_transaction) as pct,
       '2024-01-15' as run_date
from counted
