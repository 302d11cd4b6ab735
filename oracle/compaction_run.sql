select strftime(event_date, '%Y-%m-%d') as event_date, cast(4 as bigint) as file_count, count(*) as txn_count
from bank_transaction group by 1
