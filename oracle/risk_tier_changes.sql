select customer_id, version, risk_tier, strftime(effective_start, '%Y-%m-%d') as changed_on
from bank_customer_scd2 where version > 1
