select transaction_id, account_id, product_id, amount,
       strftime(event_date, '%Y-%m-%d') as transaction_date,
       case when amount is null or amount < 0 then 'DEBIT' else 'CREDIT' end as amount_direction,
       abs(amount) as abs_amount,
       amount > 10000 or amount < -10000 as is_large_transaction,
       not (transaction_id is null or account_id is null or amount is null) as is_valid
from bank_transaction
