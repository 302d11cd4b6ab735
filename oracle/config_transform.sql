select customer_id, email, risk_tier, strftime(effective_start, '%Y-%m-%d') as valid_from,
       strftime(effective_end, '%Y-%m-%d') as valid_to, is_current, version,
       upper(trim(last_name)) || ', ' || trim(first_name) as sort_name,
       cast(effective_end - effective_start as int) as days_open
from bank_customer_scd2
