"""Structured Streaming jobs for customer events."""
