"""Scalar functions, all built of Spark's own."""
