select cast(floor(epoch(event_ts) / 3600) * 3600 as bigint) as window_start, account_id,
       cast(sum(cast(amount as decimal(18,2))) as double) as hourly_total, count(*) as txn_count
from bank_transaction group by 1, 2
