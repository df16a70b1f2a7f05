"""Operators of a training-data pipeline, with their queries. Nothing else in the library imports this."""
