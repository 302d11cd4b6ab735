select 'customer' as entity, '2024-01-15' as stamped, count(*) as row_count from bank_customer_scd2
union all select 'account' as entity, '2024-01-15' as stamped, count(*) as row_count from bank_account
union all select 'transaction' as entity, '2024-01-15' as stamped, count(*) as row_count from bank_transaction
union all select 'product' as entity, '2024-01-15' as stamped, count(*) as row_count from bank_product
union all select 'branch' as entity, '2024-01-15' as stamped, count(*) as row_count from bank_branch
