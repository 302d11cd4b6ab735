with judged as (
  select account_id, case when transaction_id is null or account_id is null or account_id <= 0
    or amount is null or amount = -999999.99 or currency is null or currency = 'XXX'
    or event_date is null or transaction_type is null or transaction_type = 'UNKNOWN' then 1 else 0 end as bad
  from bank_transaction
)
select b.branch_id, b.branch_name, b.state, count(*) as txn_count, cast(sum(j.bad) as bigint) as issue_count,
       cast(sum(j.bad) as double) * 100.0 / count(*) as issue_pct
from judged j
join bank_account a on a.account_id = j.account_id
join bank_branch b on b.branch_id = a.branch_id
where j.account_id > 0 and a.branch_id > 0
group by 1, 2, 3
