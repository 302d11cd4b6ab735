select a.account_id, a.customer_id, c.first_name, c.last_name, c.risk_tier, a.branch_id,
       strftime(a.open_date, '%Y-%m-%d') as open_date, a.balance
from bank_account a left join bank_customer_scd2 c on c.customer_id = a.customer_id and c.is_current
where a.status = 'Closed'
