"""Operators for training-data pipelines, one module each; their queries and SQL are in ``queries``."""
