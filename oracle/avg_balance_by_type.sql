select account_type, count(*) as account_count,
       cast(sum(cast(balance as decimal(18,2))) as double) / count(balance) as avg_balance
from bank_account group by 1
