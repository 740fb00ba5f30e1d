"""Report plans, the report catalog and the bundle runner."""
