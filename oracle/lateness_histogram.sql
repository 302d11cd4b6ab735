select cast(ingest_date - event_date as int) as days_late, count(*) as txn_count from bank_transaction group by 1
