select product_id, product_name, product_group as description,
       case when product_name ilike '%debit%' then 'Debit'
            when product_name ilike '%credit%' then 'Credit'
            when product_name ilike '%saving%' then 'Savings'
            when product_name ilike '%loan%' then 'Loan'
            when product_name ilike '%check%' then 'Checking'
            else 'Other' end as product_category,
       coalesce(product_name not ilike '%debit%' and (product_name ilike '%credit%' or
         (product_name ilike '%loan%' and product_name not ilike '%saving%')), false) as is_lending_product,
       trim(regexp_replace(product_name, '\s+[0-9]+$', '')) as product_name_clean
from bank_product
