with counted as (
  select 'transaction_id' as column_name, count(*) as n, count(*) - count(transaction_id) as nulls, 0 as bad from bank_transaction
  union all select 'account_id', count(*), count(*) - count(account_id), count(*) filter (where account_id = -1) from bank_transaction
  union all select 'product_id', count(*), count(*) - count(product_id), 0 from bank_transaction
  union all select 'branch_id', count(*), count(*) - count(branch_id), 0 from bank_transaction
  union all select 'amount', count(*), count(*) - count(amount), count(*) filter (where amount = -999999.99) from bank_transaction
  union all select 'currency', count(*), count(*) - count(currency), count(*) filter (where currency = 'XXX') from bank_transaction
  union all select 'transaction_type', count(*), count(*) - count(transaction_type), count(*) filter (where transaction_type = 'UNKNOWN') from bank_transaction
  union all select 'status', count(*), count(*) - count(status), 0 from bank_transaction
  union all select 'event_date', count(*), count(*) - count(event_date), 0 from bank_transaction
  union all select 'event_ts', count(*), count(*) - count(event_ts), 0 from bank_transaction
  union all select 'ingest_date', count(*), count(*) - count(ingest_date), 0 from bank_transaction
)
select column_name, cast(nulls as bigint) as null_rows, cast(bad as bigint) as invalid_rows,
       cast(nulls as double) * 100.0 / n as null_pct, cast(bad as double) * 100.0 / n as invalid_pct
from counted
