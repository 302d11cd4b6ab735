select strftime(event_date, '%Y-%m-01') as month, cast(sum(cast(amount as decimal(18,2))) as double) as total_amount,
       count(*) as txn_count
from bank_transaction group by 1
