"""Table-level operators: cleaning, star-schema load, quality checks."""
