with spend as (
  select a.customer_id, sum(cast(t.amount as decimal(18,2))) as total, count(*) as txn_count
  from bank_transaction t join bank_account a on a.account_id = t.account_id
  where t.status = 'Approved' and t.amount <> -999999.99 and a.customer_id > 0
  group by 1 order by total desc, a.customer_id limit 10
)
select s.customer_id, c.first_name, c.last_name, c.risk_tier, cast(s.total as double) as total_spend, s.txn_count
from spend s left join bank_customer_scd2 c on c.customer_id = s.customer_id and c.is_current
