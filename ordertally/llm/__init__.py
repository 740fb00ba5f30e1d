"""Operators for building training data: extraction, filtering, dedup, packing, archiving."""
