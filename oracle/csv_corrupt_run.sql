select case when account_id % 10 <> 3 then cast(account_id as int) end as account_id,
       case when account_id % 10 <> 3 then balance end as balance,
       case when account_id % 10 = 3 then 'x' || account_id end as raw_id
from bank_account
