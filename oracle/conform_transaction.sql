select transaction_id, account_id, product_id, amount, strftime(event_date, '%Y-%m-%d') as transaction_date
from bank_transaction
