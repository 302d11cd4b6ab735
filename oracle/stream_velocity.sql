select cast(floor(epoch(event_ts) / 120) * 120 as bigint) as window_start, account_id, count(*) as velocity_count
from bank_transaction where status = 'Approved'
group by 1, 2 having count(*) >= 5
