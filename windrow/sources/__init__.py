"""Readers: topic records, table replay, text lines."""
