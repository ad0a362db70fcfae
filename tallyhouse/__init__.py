"""Marketplace order analytics as plain Spark DataFrame jobs."""
