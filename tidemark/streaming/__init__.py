"""Structured Streaming versions of the monitors."""
