"""Operators on text and vectors that a training-data pipeline needs. Nothing outside imports this."""
