"""Batch and streaming analytics over station readings and weather forecasts, on PySpark."""
