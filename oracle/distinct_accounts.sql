select count(distinct account_id) as distinct_count from bank_transaction
