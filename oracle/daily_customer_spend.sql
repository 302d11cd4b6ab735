with ranked as (
  select *, row_number() over (partition by transaction_id order by ingest_date desc, event_ts desc) as rn
  from bank_transaction
)
select a.customer_id, strftime(t.event_date, '%Y-%m-%d') as event_date,
       cast(sum(cast(t.amount as decimal(18,2))) as double) as total_spend, count(*) as txn_count
from ranked t join bank_account a on a.account_id = t.account_id
where t.rn = 1
group by 1, 2
