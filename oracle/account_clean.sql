select account_id, customer_id, branch_id, upper(trim(account_type)) as account_type, balance,
       case when balance is null or balance >= 10000 then 'High'
            when balance < 0 then 'Overdrawn'
            when balance < 1000 then 'Low'
            else 'Medium' end as balance_tier,
       balance < 0 as is_overdrawn,
       upper(trim(account_type)) in ('CREDIT', 'LOAN') as is_credit_account,
       'active' as account_status
from bank_account
