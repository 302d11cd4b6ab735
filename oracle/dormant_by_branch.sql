select b.branch_id, b.branch_name, b.state, count(*) as dormant_accounts
from bank_account a join bank_branch b on b.branch_id = a.branch_id
where a.status = 'Dormant' group by 1, 2, 3
