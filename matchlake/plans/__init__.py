"""Table builders, checks, models and read queries."""
