select case when dayofweek(event_date) in (0, 6) then 'weekend' else 'weekday' end as day_type,
       cast(sum(cast(amount as decimal(18,2))) as double) as total_amount, count(*) as txn_count,
       cast(sum(cast(amount as decimal(18,2))) as double) / count(amount) as avg_amount
from bank_transaction where amount <> -999999.99 group by 1
