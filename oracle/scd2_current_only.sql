select t.transaction_id, strftime(t.event_date, '%Y-%m-%d') as event_date, t.amount,
       c.customer_id, c.first_name, c.last_name, c.risk_tier, c.version
from bank_transaction t
join bank_account a on a.account_id = t.account_id
join bank_customer_scd2 c on c.customer_id = a.customer_id and c.is_current
