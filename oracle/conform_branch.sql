select branch_id, branch_name, cast(null as varchar) as city, state from bank_branch
