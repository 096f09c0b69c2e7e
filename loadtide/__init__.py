"""Hourly power-grid analytics as Spark DataFrame jobs."""
