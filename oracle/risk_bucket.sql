select transaction_id, transaction_type, amount,
       case when transaction_type is null or amount is null then 'UNKNOWN'
            when amount > 5000 then 'CRITICAL'
            when amount > 1000 and transaction_type = 'Transfer' then 'HIGH'
            when amount > 500 then 'MEDIUM'
            else 'LOW' end as risk_bucket
from bank_transaction
