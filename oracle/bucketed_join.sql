select t.account_id, t.transaction_id, strftime(t.event_date, '%Y-%m-%d') as event_date, t.amount, a.account_type
from bank_transaction t join bank_account a on a.account_id = t.account_id
