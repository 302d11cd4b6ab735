select cast(account_id as int) as account_id, cast(customer_id as int) as customer_id, cast(branch_id as int) as branch_id,
       account_type, balance
from bank_account
