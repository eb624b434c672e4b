"""Jobs wired to inputs: the query catalogue and the SQL each is checked against."""
