"""Structured Streaming jobs over telemetry and forecasts."""
