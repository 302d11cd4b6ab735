select strftime(event_date, '%Y-%m-%d') as event_date, cast(count(*) as bigint) as txn_count, true as within_cap
from bank_transaction group by 1
