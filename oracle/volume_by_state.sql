select coalesce(b.state, 'Unknown') as state, cast(sum(cast(t.amount as decimal(18,2))) as double) as total_amount,
       count(*) as txn_count
from bank_transaction t
join bank_account a on a.account_id = t.account_id
join bank_branch b on b.branch_id = a.branch_id
group by 1
