"""Relational operators: joins of the report tables and ordering."""
