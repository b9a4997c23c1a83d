"""Structured Streaming: exactly-once apply, live view, drain modes."""
