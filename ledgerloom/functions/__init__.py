"""Column expressions: keys, dates, scalars, aggregates, types and SQL functions."""
