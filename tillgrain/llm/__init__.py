"""Operators for large-scale training-data pipelines, each under its own module."""
