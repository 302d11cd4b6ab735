select distinct strftime(event_date, '%Y-%m-%d') as event_date from bank_transaction
