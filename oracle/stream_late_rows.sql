with days as (
  select ingest_date, max(event_ts) as newest, row_number() over (order by ingest_date) as batch
  from bank_transaction group by 1
), marks as (
  select ingest_date, date_trunc('millisecond',
           max(newest) over (order by batch rows between unbounded preceding and 2 preceding)) - interval '1 day' as watermark
  from days
), judged as (
  select to_timestamp(floor(epoch(t.event_ts) / 3600) * 3600) at time zone 'UTC' as start, t.account_id, t.amount,
         coalesce(to_timestamp(floor(epoch(t.event_ts) / 3600) * 3600 + 3600) at time zone 'UTC' <= m.watermark, false) as late
  from bank_transaction t join marks m on m.ingest_date = t.ingest_date
)
select cast(epoch(start) as bigint) as window_start, account_id,
       cast(sum(cast(amount as decimal(18,2))) filter (where not late) as double) as hourly_total,
       count(*) filter (where not late) as txn_count, count(*) filter (where late) as late_rows
from judged
where start + interval '1 hour' <= (select date_trunc('millisecond', max(event_ts)) - interval '1 day' from bank_transaction)
group by start, account_id
