with volume as (
  select account_id, count(*) as txn_count from bank_transaction where account_id > 0 group by 1
)
select count(*) as accounts, round(corr(v.txn_count, date '2023-12-31' - a.open_date), 6) as age_volume_corr
from volume v join bank_account a on a.account_id = v.account_id
