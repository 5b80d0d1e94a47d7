"""Batch analytics over API access logs, written as PySpark DataFrame transforms."""
