"""Structured Streaming jobs for order events."""
