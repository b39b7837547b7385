"""Readers, table projections and writers."""
