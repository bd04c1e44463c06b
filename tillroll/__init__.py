"""Retail customer analytics as Spark jobs."""
