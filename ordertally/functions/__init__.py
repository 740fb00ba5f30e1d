"""Column-level building blocks: dates, predicates and aggregates."""
