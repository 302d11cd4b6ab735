select currency, cast(sum(cast(amount as decimal(18,2))) as double) as revenue, count(*) as txn_count
from bank_transaction where status = 'Approved' and amount <> -999999.99 group by 1
