with numbered as (
  select account_id, event_date, cast(event_date - date '1970-01-01' as int) as day_no, amount from bank_transaction
), averaged as (
  select account_id, event_date, count(amount) over w as rolling_count,
         cast(sum(cast(amount as decimal(18,2))) over w as double) as total
  from numbered
  window w as (partition by account_id order by day_no range between 6 preceding and current row)
)
select distinct account_id, strftime(event_date, '%Y-%m-%d') as event_date, rolling_count,
       case when rolling_count > 0 then total / rolling_count end as rolling_avg
from averaged
