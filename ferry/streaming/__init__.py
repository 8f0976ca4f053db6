"""Structured Streaming form of the bounded-batch copy."""
