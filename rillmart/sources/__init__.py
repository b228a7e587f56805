"""Readers: topics, change records, tables."""
