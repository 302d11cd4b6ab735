select t.transaction_id, t.account_id, t.product_id, t.branch_id, t.amount, t.currency, t.transaction_type, t.status,
       strftime(t.event_date, '%Y-%m-%d') as event_date, cast(floor(epoch(t.event_ts)) as bigint) as event_ts,
       strftime(t.ingest_date, '%Y-%m-%d') as ingest_date,
       coalesce(p.product_name, 'Unknown') as product_name, coalesce(p.product_group, 'Unknown') as product_group
from bank_transaction t left join bank_product p on p.product_id = t.product_id
