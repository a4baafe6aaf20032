"""Independent SQL statements of every registered query, for checking results."""
