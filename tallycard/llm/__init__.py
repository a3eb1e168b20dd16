"""Operators of a training-data pipeline; see the README. Nothing else in the library imports this."""
