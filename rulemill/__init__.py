"""Merge prioritised rule lists into published editions, as Spark jobs."""
