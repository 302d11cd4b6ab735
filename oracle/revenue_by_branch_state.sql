select b.branch_id, b.branch_name, b.state, cast(sum(cast(t.amount as decimal(18,2))) as double) as revenue,
       count(*) as txn_count
from bank_transaction t
join bank_account a on a.account_id = t.account_id
join bank_branch b on b.branch_id = a.branch_id
where t.status = 'Approved' and t.amount <> -999999.99
group by 1, 2, 3
