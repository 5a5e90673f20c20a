"""Structured Streaming jobs; they use the same operators as batch."""
