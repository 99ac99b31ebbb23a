"""Readers: JDBC, incremental extracts, files, schema catalogue."""
