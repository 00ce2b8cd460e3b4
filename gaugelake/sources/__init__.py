"""Landed payloads and partitioned tables."""
