select count(*) as txn_count, count(*) filter (where status = 'Approved') as approved_count,
       cast(sum(cast(amount as decimal(18,2))) as double) / count(amount) as avg_amount
from bank_transaction
