select count(*) as rows_before, count(distinct transaction_id) as rows_after,
       count(*) - count(distinct transaction_id) as rows_removed
from bank_transaction
