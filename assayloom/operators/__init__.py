"""Steps that take a table and return a table."""
