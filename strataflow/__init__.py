"""Layered data-lake pipelines as parameterised PySpark DataFrame functions."""
