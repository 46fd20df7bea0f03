"""Marketplace analytics as PySpark DataFrame operators and batch pipelines."""
