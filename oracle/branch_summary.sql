select b.branch_id, b.branch_name, b.state,
       cast(sum(cast(t.amount as decimal(18,2))) as double) as total_amount,
       count(*) as txn_count,
       cast(sum(cast(t.amount as decimal(18,2))) as double) / count(t.amount) as avg_amount
from bank_transaction t
join bank_account a on a.account_id = t.account_id
join bank_branch b on b.branch_id = a.branch_id
where t.status <> 'Reversed' and t.account_id > 0 and a.branch_id > 0
group by 1, 2, 3
