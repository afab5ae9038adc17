"""Operators for preparing training text, and the pipeline's building blocks."""
