"""Sinks, keyed upsert tables and groups of streaming queries."""
