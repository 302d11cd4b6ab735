select customer_id, first_name, last_name, email, phone from bank_customer_scd2
