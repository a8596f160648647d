"""Table-in, table-out operators with column names as parameters."""
