select strftime(event_date, '%Y-%m-%d') as event_date,
       cast(sum(cast(amount as decimal(18,2))) as double) as total_amount,
       count(*) as txn_count
from bank_transaction
where event_date >= date '2024-01-05' and event_date <= date '2024-01-11'
group by 1
