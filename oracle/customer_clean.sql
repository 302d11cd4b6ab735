with trimmed as (
  select customer_id, trim(first_name) as f, trim(last_name) as l, email, phone from bank_customer_scd2
), named as (
  select customer_id, upper(left(f, 1)) || lower(substring(f, 2)) as first_name,
         upper(left(l, 1)) || lower(substring(l, 2)) as last_name, email, phone
  from trimmed
)
select customer_id, first_name, last_name, email, phone,
       first_name || ' ' || last_name as full_name,
       case when email like '%@%' then split_part(email, '@', 2) end as email_domain,
       email is not null and regexp_full_match(email, '[^@\s]+@[^@\s]+\.[^@\s]+') as is_email_valid,
       phone is not null and regexp_full_match(phone, '[0-9]{3}-[0-9]{3}-[0-9]{4}') as is_phone_valid
from named
