"""Structured Streaming jobs: block replay, rate windows, deduplication, rollback."""
