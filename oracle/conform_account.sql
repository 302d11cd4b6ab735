select account_id, customer_id, branch_id, account_type, balance from bank_account
