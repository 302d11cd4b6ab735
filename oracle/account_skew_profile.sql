select account_id, count(*) as key_rows, cast(count(*) as double) / (select count(*) from bank_transaction) as key_share
from bank_transaction group by 1 order by key_rows desc, account_id nulls last limit 10
