select a.account_type, count(*) as txn_count, cast(sum(cast(t.amount as decimal(18,2))) as double) as total_amount
from bank_transaction t join bank_account a on a.account_id = t.account_id
group by 1
