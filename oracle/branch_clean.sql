select branch_id, branch_name, cast(null as varchar) as city, trim(state) as state,
       upper(branch_name) as branch_upper,
       case when branch_name ilike '%main%' then 'Main'
            when branch_name ilike '%downtown%' then 'Downtown'
            when branch_name ilike '%suburban%' then 'Suburban'
            when branch_name ilike '%airport%' then 'Airport'
            when branch_name ilike '%online%' then 'Online'
            when branch_name ilike '%international%' then 'International'
            else 'Other' end as branch_type,
       state is not null and regexp_full_match(trim(state), '[A-Z]{2}') as is_state_valid
from bank_branch
