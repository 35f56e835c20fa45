"""Named plans: every operator bound to the test tables, with the SQL it is checked against."""
