"""Readers, writers, table rules and the adapters for the test tables."""
