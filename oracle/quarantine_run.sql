with damaged as (
  select * replace (case when transaction_id % 7 = 0 then null else transaction_id end as transaction_id) from bank_transaction
), latest as (
  select * from damaged where transaction_id is null
  union all
  select * from damaged where transaction_id is not null
  qualify row_number() over (partition by transaction_id order by ingest_date desc, event_ts desc) = 1
), named as (
  select concat_ws(',',
           case when transaction_id is null then 'failed_txn_id' end,
           case when account_id is null or account_id <= 0 then 'failed_acct_id' end,
           case when amount is null or amount = -999999.99 then 'failed_amount' end,
           case when currency is null or currency = 'XXX' then 'failed_currency' end) as reasons
  from latest
)
select reasons, count(*) as txn_count from named where reasons <> '' group by 1
