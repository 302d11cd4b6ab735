select t.transaction_id, t.account_id, t.product_id, t.branch_id as txn_branch_id, t.amount, t.currency,
       t.transaction_type, t.status, strftime(t.event_date, '%Y-%m-%d') as event_date,
       cast(floor(epoch(t.event_ts)) as bigint) as event_ts, strftime(t.ingest_date, '%Y-%m-%d') as ingest_date,
       a.customer_id, a.branch_id, a.account_type, a.status as account_status,
       strftime(a.open_date, '%Y-%m-%d') as account_open_date, a.balance as account_balance,
       b.branch_name, b.state as branch_state, strftime(b.open_date, '%Y-%m-%d') as branch_open_date,
       strftime(c.effective_start, '%Y-%m-%d') as effective_start,
       strftime(c.effective_end, '%Y-%m-%d') as effective_end,
       c.first_name, c.last_name, c.email, c.phone, c.risk_tier, c.is_current, c.version,
       p.product_name, p.product_group
from bank_transaction t
left join bank_account a on a.account_id = t.account_id
left join bank_branch b on b.branch_id = a.branch_id
left join bank_product p on p.product_id = t.product_id
left join bank_customer_scd2 c on c.customer_id = a.customer_id
 and t.event_date between c.effective_start and coalesce(c.effective_end, date '9999-12-31')
