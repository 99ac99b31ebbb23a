"""Incremental pick-up of dropped files with Structured Streaming."""
