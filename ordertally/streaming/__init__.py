"""Incremental runs of the daily report as order files arrive (Structured Streaming)."""
