select 'failed_txn_id' as rule, count(*) as violations from bank_transaction where transaction_id is null
union all select 'failed_acct_id', count(*) from bank_transaction where account_id is null or account_id <= 0
union all select 'failed_amount', count(*) from bank_transaction where amount is null or amount = -999999.99
union all select 'failed_currency', count(*) from bank_transaction where currency is null or currency = 'XXX'
union all select 'failed_date', count(*) from bank_transaction where event_date is null
union all select 'failed_type', count(*) from bank_transaction where transaction_type is null or transaction_type = 'UNKNOWN'
