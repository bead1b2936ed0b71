"""Millrace: reusable PySpark operators, jobs and streams for tabular data."""
