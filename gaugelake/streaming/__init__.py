"""Structured Streaming over landed payloads."""
