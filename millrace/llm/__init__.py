"""Operators of a training-data pipeline, each with the query that applies it to a whole table."""
