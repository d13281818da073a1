"""Spark-first analytics over five-dimensional image arrays."""
