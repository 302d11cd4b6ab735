select 'customer' as entity, 'customer_table' as target, count(*) as row_count from bank_customer_scd2
union all select 'account' as entity, 'account_table' as target, count(*) as row_count from bank_account
union all select 'transaction' as entity, 'transaction_table' as target, count(*) as row_count from bank_transaction
union all select 'product' as entity, 'product_table' as target, count(*) as row_count from bank_product
union all select 'branch' as entity, 'branch_table' as target, count(*) as row_count from bank_branch
