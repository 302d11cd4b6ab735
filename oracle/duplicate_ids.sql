select transaction_id, count(*) as copies from bank_transaction group by 1 having count(*) > 1
