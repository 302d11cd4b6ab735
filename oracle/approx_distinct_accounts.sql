select count(distinct account_id) as exact, true as within_5_percent from bank_transaction
