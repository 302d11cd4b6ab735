with days as (
  select event_date from bank_transaction group by 1
  having count(*) filter (where ingest_date - event_date >= 3) * 4 > count(*)
)
select strftime(event_date, '%Y-%m-%d') as event_date,
       cast(sum(cast(amount as decimal(18,2))) as double) as total_amount, count(*) as txn_count
from bank_transaction where event_date in (select event_date from days)
group by 1
