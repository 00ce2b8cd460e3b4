"""Whole runs: landed payloads to tables, with run accounting."""
