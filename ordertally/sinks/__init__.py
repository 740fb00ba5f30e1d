"""Sinks: report bundle, per-date output, empty-day markers and the run manifest."""
