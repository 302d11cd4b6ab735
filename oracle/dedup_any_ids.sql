select distinct transaction_id from bank_transaction
