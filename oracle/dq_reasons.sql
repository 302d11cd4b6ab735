with named as (
  select transaction_id, cast(floor(epoch(event_ts)) as bigint) as event_ts,
         concat_ws(',',
           case when transaction_id is null then 'failed_txn_id' end,
           case when account_id is null or account_id <= 0 then 'failed_acct_id' end,
           case when amount is null or amount = -999999.99 then 'failed_amount' end,
           case when currency is null or currency = 'XXX' then 'failed_currency' end,
           case when event_date is null then 'failed_date' end,
           case when transaction_type is null or transaction_type = 'UNKNOWN' then 'failed_type' end
         ) as rejection_reasons
  from bank_transaction
)
select * from named where rejection_reasons <> ''
