select account_id, transaction_id, strftime(event_date, '%Y-%m-%d') as event_date, amount,
       cast(sum(cast(amount as decimal(18,2))) over (partition by account_id order by event_date, event_ts) as double)
         as running_balance,
       cast(row_number() over (partition by account_id order by event_date, event_ts, transaction_id) as int) as txn_rank
from bank_transaction
