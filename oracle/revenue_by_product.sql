select t.product_id, coalesce(p.product_name, 'Unknown') as product_name,
       coalesce(p.product_group, 'Unknown') as product_group,
       cast(sum(cast(t.amount as decimal(18,2))) as double) as revenue, count(*) as txn_count
from bank_transaction t left join bank_product p on p.product_id = t.product_id
where t.status = 'Approved' and t.amount <> -999999.99
group by 1, 2, 3
