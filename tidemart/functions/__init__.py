"""Scalar and table functions built from Spark's own expressions."""
