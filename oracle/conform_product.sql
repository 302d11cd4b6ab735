select product_id, product_name as prod_name, product_group as description from bank_product
