with days as (
  select event_date, count(*) as n, row_number() over (order by event_date) - 1 as day from bank_transaction group by 1
)
select cast(day // 3 as bigint) as batch_id, cast(sum(n) as bigint) as input_rows, false as had_late_rows
from days group by 1
