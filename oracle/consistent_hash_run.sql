with keys as (
  select account_id, count(*) as n from bank_transaction group by 1
)
select cast(sum(n) as bigint) as txn_count, count(*) as key_count, cast(8 as int) as owner_count,
       cast(0 as bigint) as split_keys
from keys
