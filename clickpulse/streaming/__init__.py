"""Streaming job wiring, the idempotent metrics sink and table storage."""
