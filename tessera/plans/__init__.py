"""Plans over the synthetic tables: one carrier query for each operator, and its SQL."""
