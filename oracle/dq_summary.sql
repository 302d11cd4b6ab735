with judged as (
  select case when transaction_id is null or account_id is null or account_id <= 0
    or amount is null or amount = -999999.99 or currency is null or currency = 'XXX'
    or event_date is null or transaction_type is null or transaction_type = 'UNKNOWN' then 1 else 0 end as bad
  from bank_transaction
)
select count(*) as total_rows, cast(count(*) - sum(bad) as bigint) as valid_rows, cast(sum(bad) as bigint) as quarantined_rows,
       cast(sum(bad) as double) * 100.0 / count(*) as quarantined_pct
from judged
